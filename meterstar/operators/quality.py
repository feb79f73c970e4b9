"""Declarative data-quality checks (DQ-1..14).

A check run returns one row per check: ``check, column, failing_rows, passed``.
All checks on one table take one scan: row-level ones (not_null, accepted_values, expression_is_true,
non_negative, positive, row_count) and relationships are flags that one aggregation adds up, and all
uniqueness checks share one shuffle on (check, key). The report is tiny (one row per check), so
``enforce`` may collect it.

NULL handling follows the warehouse tests: accepted_values and expression_is_true ignore NULLs,
unique ignores NULL keys, unique_combination_of_columns groups NULLs together, relationships
ignore NULL child keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = "check string, column string, failing_rows bigint, passed boolean"


@dataclass
class Check:
    kind: str                      # not_null | accepted_values | expression_is_true | non_negative | positive
    column: str                    # | unique | unique_combination | relationships | row_count | scalar
    values: Sequence = ()          # accepted values / combination columns
    expr: str | None = None        # expression_is_true, scalar query
    parent: DataFrame | None = None
    parent_key: str | None = None
    expected: int | None = None    # row_count, scalar
    name: str | None = field(default=None)

    @property
    def label(self) -> str:
        return self.name or self.kind


def not_null(c): return Check("not_null", c)
def accepted_values(c, values): return Check("accepted_values", c, values=list(values))
def expression_is_true(expr, name=None): return Check("expression_is_true", expr, expr=expr, name=name)
def non_negative(c): return Check("non_negative", c)
def positive(c): return Check("positive", c)
def unique(c): return Check("unique", c)
def unique_combination(cols): return Check("unique_combination", ",".join(cols), values=list(cols))
def relationships(c, parent, parent_key): return Check("relationships", c, parent=parent, parent_key=parent_key)
def row_count(n): return Check("row_count", "*", expected=n)
def scalar(sql_expr_df: DataFrame, expected, name): return Check("scalar", "*", parent=sql_expr_df, expected=expected,
                                                                name=name)


def _failing(check: Check) -> Column:
    c = F.col(check.column) if check.kind != "expression_is_true" else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*check.values)
    if check.kind == "expression_is_true":
        return ~F.expr(check.expr)
    if check.kind == "non_negative":
        return c < 0
    if check.kind == "positive":
        return c <= 0
    raise ValueError(check.kind)


def _row(label: str, column: str, failing: Column) -> Column:
    return F.struct(F.lit(label).alias("check"), F.lit(column).alias("column"),
                    failing.cast("bigint").alias("failing_rows"))


def run_models(runs: Sequence[tuple[str, DataFrame, Sequence[Check]]]) -> DataFrame:
    """Check several models in one report: ``model, check, column, failing_rows, passed``."""
    out = None
    for model, df, checks in runs:
        r = run_checks(df, checks).select(F.lit(model).alias("model"), "*")
        out = r if out is None else out.unionByName(r)
    return out


def _key_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """Key columns as one text that tells any two keys apart: each as its length and its value, NULL as '-'."""
    kinds = dict(df.dtypes)
    parts = []
    for c in cols:
        v = F.col(c) + F.lit(0).cast(kinds[c]) if kinds[c] in ("float", "double") else F.col(c)   # -0.0 equals 0.0
        parts.append(F.coalesce(F.concat(F.octet_length(v.cast("string")), F.lit(":"), v.cast("string")), F.lit("-")))
    return F.concat(*parts)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; one report row per check.

    All checks read ``df`` in one scan. Relationships are left joins to the parents' distinct keys, which only
    flag a row. Without keyed checks one aggregate counts all failures. With them, each row gives one entry for
    its row-level flags (which the map side adds up) and one (check, key) entry per uniqueness check, so a
    single shuffle on (check, key) serves all of them; keys are compared as whole texts.
    """
    keyed = [c for c in checks if c.kind in ("unique", "unique_combination")]
    scalars = [c for c in checks if c.kind == "scalar"]
    rows = [c for c in checks if c not in keyed and c not in scalars]
    src, failing = df, []
    for i, c in enumerate(rows):
        if c.kind == "relationships":
            keys = c.parent.select(F.col(c.parent_key).alias(f"__parent{i}")).where(F.col(f"__parent{i}").isNotNull()).distinct()
            src = src.join(keys, F.col(c.column) == F.col(f"__parent{i}"), "left")
            failing.append(F.col(c.column).isNotNull() & F.col(f"__parent{i}").isNull())
        else:
            failing.append(F.lit(True) if c.kind == "row_count" else _failing(c))
    parts: list[DataFrame] = []
    if keyed:
        flags = [F.coalesce(x, F.lit(False)).cast("bigint").alias(f"f{i}") for i, x in enumerate(failing)]
        none = [F.lit(0).cast("bigint").alias(f"f{i}") for i in range(len(failing))]
        entries = [F.struct(F.lit(-1).alias("id"), F.lit(None).cast("string").alias("key"), *flags)] if rows else []
        for j, c in enumerate(keyed):
            cols = c.values if c.kind == "unique_combination" else [c.column]
            entry = F.struct(F.lit(j).alias("id"), _key_text(df, cols).alias("key"), *none)
            entries.append(entry if c.kind == "unique_combination" else F.when(F.col(c.column).isNotNull(), entry))
        each = src.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")
        groups = each.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"f{i}").alias(f"f{i}") for i in range(len(rows))])
        counts = [F.coalesce(F.sum(f"f{i}"), F.lit(0)) for i in range(len(rows))]
        counts += [F.count_if((F.col("id") == j) & (F.col("n") > 1)) for j in range(len(keyed))]
    else:
        groups, counts = src, [F.count_if(x) for x in failing]
    done = [*rows, *keyed]
    if done:
        counts = [F.abs(n - F.lit(c.expected)) if c.kind == "row_count" else n for c, n in zip(done, counts)]
        agg = groups.agg(*[n.alias(f"n{i}") for i, n in enumerate(counts)])
        parts.append(agg.select(F.inline(F.array(*[_row(c.label, c.column, F.col(f"n{i}")) for i, c in enumerate(done)]))))
    for c in scalars:
        v = c.parent.select(F.col(c.parent.columns[0]).alias("v"))
        failed = v.agg(F.when(F.first("v") == F.lit(c.expected), 0).otherwise(1).alias("f"))
        parts.append(failed.select(F.inline(F.array(_row(c.label, c.column, F.col("f"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failing_rows") == 0)


def flag_any(df: DataFrame, predicate: Column, alias: str = "value") -> DataFrame:
    """AG-10: 1 when any row satisfies ``predicate`` else 0 (CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0)."""
    return df.agg(F.when(F.count_if(predicate) > 0, 1).otherwise(0).alias(alias))


def freshness(df: DataFrame, loaded_at: str, run_at: str, warn_after_hours: float = 24,
              error_after_hours: float = 48, source: str = "source") -> DataFrame:
    """DQ-13: age of the newest row at ``run_at`` -> pass / warn / error."""
    newest = F.max(F.col(loaded_at))
    age = (F.unix_seconds(F.lit(run_at).cast("timestamp")) - F.unix_seconds(newest.cast("timestamp"))) / F.lit(3600.0)
    return df.agg(F.lit(source).alias("source"), newest.alias("max_loaded_at"), age.alias("age_hours")).withColumn(
        "status", F.when(F.col("age_hours") > error_after_hours, "error")
        .when(F.col("age_hours") > warn_after_hours, "warn").otherwise("pass"))


def contract_violations(df: DataFrame, expected: T.StructType | str) -> list[str]:
    """DQ-12: names and types must match the contract (column order free). Metadata only."""
    if isinstance(expected, str):
        expected = T.StructType.fromDDL(expected)
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    problems = [f"missing column {n}" for n in want if n not in have]
    problems += [f"unexpected column {n}" for n in have if n not in want]
    problems += [f"{n}: {have[n].simpleString()} != {t.simpleString()}" for n, t in want.items()
                 if n in have and have[n] != t]
    return problems


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """DQ-14: fail the build when a check failed. The report has one row per check."""
    failed = [r for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError("; ".join(f"{r['check']}({r['column']}): {r['failing_rows']}" for r in failed))
    return report

