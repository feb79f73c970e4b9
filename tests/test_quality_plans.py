"""All checks of a table take one scan, all uniqueness checks one shuffle, and keys are compared exactly."""
import re

import pytest
from pyspark.sql import functions as F

from meterstar.operators import quality as Q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dq") / "t")
    rows = [(i % 90, i, f"k{i % 97}", float(i % 5) if i % 7 else None, None if i % 11 else "x") for i in range(100)]
    spark.createDataFrame(rows, "a int, b int, c string, d double, e string").write.parquet(path)
    return spark.read.parquet(path)


def result(df):
    return {(r["check"], r["column"]): (r["failing_rows"], r["passed"]) for r in df.collect()}


def test_one_scan_and_one_keyed_shuffle(spark, table):
    parent = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "id int")
    checks = [Q.not_null("e"), Q.unique("a"), Q.unique("b"), Q.unique_combination(["c", "d"]), Q.row_count(100),
              Q.relationships("a", parent, "id"), Q.relationships("b", parent, "id"), Q.accepted_values("c", ["k1", "k2"]), Q.non_negative("d")]
    got = Q.run_checks(table, checks)
    p = plan(got)
    assert len(re.findall(r"FileScan parquet", p)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+, key#\d+", p)) == 1
    rows = [tuple(r) for r in table.collect()]
    count = lambda keys: sum(1 for k in set(keys) if keys.count(k) > 1)
    want = {("not_null", "e"): sum(r[4] is None for r in rows), ("unique", "a"): count([r[0] for r in rows]), ("unique", "b"): 0,
            ("unique_combination", "c,d"): count([(r[2], r[3]) for r in rows]), ("row_count", "*"): 0,
            ("relationships", "a"): sum(r[0] >= 50 for r in rows), ("relationships", "b"): sum(r[1] >= 50 for r in rows),
            ("accepted_values", "c"): sum(r[2] not in ("k1", "k2") for r in rows), ("non_negative", "d"): 0}
    assert result(got) == {k: (n, n == 0) for k, n in want.items()}


def test_keys_are_told_apart_exactly(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("", None), (None, ""), ("2:a", "-"), ("2", "a-"), ("-", ""), (None, "")],
                               "a string, b string")
    got = result(Q.run_checks(df, [Q.unique_combination(["a", "b"]), Q.unique("a")]))
    assert got[("unique_combination", "a,b")][0] == 1      # the repeated (NULL, '')
    assert got[("unique", "a")][0] == 0                    # NULL keys are ignored
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.5,), (float("nan"),), (float("nan"),)], "x double")
    assert result(Q.run_checks(zeros, [Q.unique("x")]))[("unique", "x")][0] == 2


def test_empty_tables_and_hot_keys(spark):
    none = spark.createDataFrame([], "a int")
    assert result(Q.run_checks(none, [Q.unique("a"), Q.not_null("a"), Q.row_count(0)])) == {
        ("unique", "a"): (0, True), ("not_null", "a"): (0, True), ("row_count", "*"): (0, True)}
    hot = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"))
    p = plan(Q.run_checks(hot, [Q.unique("a")]))
    assert p.count("partial_count") >= 1                    # a hot key is counted on the map side
    assert result(Q.run_checks(hot, [Q.unique("a")]))[("unique", "a")][0] == 1
