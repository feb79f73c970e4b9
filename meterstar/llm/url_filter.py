"""URL filters by a path-template tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import staged

# Fixed rules: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEPTH = 4              # path segments that the tree tells apart; the rest is one wildcard tail
PRIOR_WEIGHT = 4.0     # labelled pages that the parent's purity counts as
SIMILAR_Z = 1.96       # branches whose block rates differ by fewer standard errors are alike
REJECT = 0.5           # smoothed share of blocked labels from which a template is rejected

# Segments that vary by page: numbers (with an ending), hexadecimal ids, long ids with a digit.
VARIABLE = r"^[0-9]+(\.[a-z0-9]+)?$|^[0-9a-f]{8,}$|^(?=.*[0-9])[0-9A-Za-z_-]{12,}$"


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits host and path, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _template(path: Column) -> Column:
    """Up to DEPTH segments, variable ones as ``*``, and ``**`` for what is deeper."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    general = F.transform(F.slice(parts, 1, DEPTH), lambda x: F.when(x.rlike(VARIABLE), F.lit("*")).otherwise(x))
    return F.when(F.size(parts) > DEPTH, F.concat(general, F.array(F.lit("**")))).otherwise(general)


def _smooth(bad: Column, n: Column, prior: Column) -> Column:
    return (bad + PRIOR_WEIGHT * prior) / (n + PRIOR_WEIGHT)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Allow or block every url: by the longest fitting rule, else by its path template.

    Labels are the verdicts of the rules. Per host the paths form a tree whose variable segments are
    wildcards. Nodes count labelled and blocked pages. Sibling branches (children of one node) whose
    block rate does not differ from that of all children together by more than SIMILAR_Z standard
    errors are merged into one branch, which pools their counts; the others keep their own. A node's
    purity is its share of blocked labels, smoothed by PRIOR_WEIGHT pages of its parent's purity,
    down from the share over all hosts with the same first segment, and that from the whole table.
    A page with no rule is blocked when the purity of its deepest template reaches REJECT.

    Returns ``page_id, host, path, rule, verdict, template, purity``, one row per row of ``pages``.
    A null url, or one without ``://``, has an empty host and path and the purity of the whole table
    decides; with no label at all that purity is 0: allow. An empty table gives an empty result.
    """
    host, path = parsed(F.col(url_col))
    p = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    p = p.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("r"), _template(F.col("path")).alias("parts"))
    # one row per host and template from here on: the tree is far smaller than the table
    leaf = staged(p.groupBy("host", "parts").agg(F.count("r").cast("double").alias("n"),
                                                 F.count_if(F.col("r.verdict") == "block").cast("double").alias("bad")), "templates")
    first = F.coalesce(F.get("parts", F.lit(0)), F.lit(""))
    base = F.coalesce(leaf.agg(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0.0))).scalar(), F.lit(0.0))
    alike_first = leaf.groupBy(first.alias("first")).agg(_smooth(F.sum("bad"), F.sum("n"), base).alias("prior"))
    # sums are partial on the map side, so a host with a third of all templates is no hot task
    roots = (leaf.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("bad").alias("hbad")))
    above = (leaf.select("host", first.alias("first")).distinct().join(alike_first, "first").join(roots, "host")
             .select("host", F.array(F.col("first")).alias("key"), F.col("hn").alias("n"), F.col("hbad").alias("bad"),
                     _smooth(F.col("hbad"), F.col("hn"), F.col("prior")).alias("p")))
    nodes = None
    for d in range(1, DEPTH + 2):
        # a node's parent: the host itself (smoothed for this first segment), or the path one shorter
        parent = F.array(first) if d == 1 else F.slice("parts", 1, d - 1)
        level = (leaf.where((F.size("parts") >= d) | (F.lit(d == 1)))
                 .groupBy("host", parent.alias("key"), F.slice("parts", 1, d).alias("parts"))
                 .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
        up = above.select("host", "key", F.col("n").alias("up_n"), F.col("bad").alias("up_bad"), F.col("p").alias("up_p"))
        rate, own = F.col("up_bad") / F.nullif(F.col("up_n"), F.lit(0.0)), F.col("bad") / F.nullif(F.col("n"), F.lit(0.0))
        error = F.sqrt(rate * (1 - rate) / F.nullif(F.col("n"), F.lit(0.0)))
        level = level.join(up, ["host", "key"]).withColumn(
            "alike", F.coalesce(F.abs(own - rate) <= SIMILAR_Z * error, F.lit(True)))
        siblings = ["host"] if d == 1 else ["host", "key"]
        pooled = (level.where("alike").groupBy(*siblings)
                  .agg(F.sum("n").alias("pool_n"), F.sum("bad").alias("pool_bad")))
        level = staged(level.join(pooled, siblings, "left").select(
            "host", "parts", "n", "bad",
            F.when(F.col("alike"), _smooth(F.col("pool_bad"), F.col("pool_n"), F.col("up_p")))
            .otherwise(_smooth(F.col("bad"), F.col("n"), F.col("up_p"))).alias("p")), "tree")
        above = level.select("host", F.col("parts").alias("key"), "n", "bad", "p")
        nodes = level if nodes is None else nodes.unionByName(level)
    tree = nodes.select("host", "parts", F.col("p").alias("purity"))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow")))
    return p.join(tree, ["host", "parts"]).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"),
        F.concat(F.lit("/"), F.array_join("parts", "/")).alias("template"), "purity")
