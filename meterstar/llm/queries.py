"""The queries opN_<name>: each applies its operator to its whole table. ORACLE has SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterstar.llm import (
    ann, content_sort, decontam, merkle, mixing, ngram_join, paragraph_dedup, pii, prefix_trie, quality, token_counts, toxicity,
    url_filter)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels"), "quality"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, count_col="n_replaced")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_rows(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.equal_texts(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_substring_dedup, op3_ngram_join, op4_quality, op5_decontaminate,
    op6_mix_sources, op7_nearest, op8_token_counts, op9_pseudonyms, op10_url_filter,
    op11_merkle_manifest, op12_prefix_trie, op13_exact_dedup)}

ORACLE: dict[str, str] = {}

# Level L with sum(least(2 * size, weight * L)) = 1.5 * all sizes, found at the break points 2 * size / weight;
# then a running sum over the documents of a source in the order of their hash.
ORACLE["op6_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap FROM s),
breaks AS (
  SELECT a.cap / a.weight AS brk, sum(least(b.cap, b.weight * (a.cap / a.weight))) AS given
  FROM w a, w b GROUP BY 1),
first_enough AS (
  SELECT min(brk) AS brk FROM breaks, (SELECT 1.5::DOUBLE * sum(source_size) AS budget FROM s) WHERE given >= budget - 1e-6),
level AS (
  SELECT (1.5::DOUBLE * sum(source_size) - sum(CASE WHEN cap / weight < brk THEN cap ELSE 0 END))
         / sum(CASE WHEN cap / weight >= brk THEN weight END) AS level
  FROM w, first_enough),
t AS (
  SELECT source, source_size, least(cap, weight * coalesce(level, 0)) AS target FROM w, level),
o AS (
  SELECT d.*, source_size, target, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS whole,
         CAST(round(target) AS BIGINT) - CASE WHEN target >= source_size THEN source_size ELSE 0 END AS budget,
         sum(size) OVER (PARTITION BY d.source, h) AS tied,
         sum(size) OVER (PARTITION BY d.source ORDER BY h) - sum(size) OVER (PARTITION BY d.source, h) AS below
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + CASE WHEN size = 0 OR below >= budget THEN 0 WHEN below + tied <= budget THEN size
                                ELSE ((budget - below) * size) // tied END AS BIGINT) AS taken
FROM o
"""

# The same tree with one join per level; the levels are written out by a rule.
_TEMPLATE_LEVEL = """
raw{d} AS (
  SELECT l.host, {key} AS key, l.parts[1:{d}] AS parts, sum(l.n) AS n, sum(l.bad) AS bad
  FROM leaf l WHERE len(l.parts) >= {d} OR {d} = 1 GROUP BY ALL),
near{d} AS (
  SELECT r.*, u.p AS up_p, coalesce(abs(r.bad / nullif(r.n, 0) - u.bad / nullif(u.n, 0)) <= 1.96::DOUBLE
         * sqrt(u.bad / nullif(u.n, 0) * (1 - u.bad / nullif(u.n, 0)) / nullif(r.n, 0)), true) AS alike
  FROM raw{d} r JOIN {up} u ON r.host = u.host AND r.key = u.key),
pool{d} AS (
  SELECT *, sum(CASE WHEN alike THEN n END) OVER (PARTITION BY host{by}) AS pn,
            sum(CASE WHEN alike THEN bad END) OVER (PARTITION BY host{by}) AS pb FROM near{d}),
node{d} AS (
  SELECT host, parts AS key, parts, n, bad, CASE WHEN alike THEN (pb + 4.0::DOUBLE * up_p) / (pn + 4.0::DOUBLE)
         ELSE (bad + 4.0::DOUBLE * up_p) / (n + 4.0::DOUBLE) END AS p FROM pool{d}),"""

ORACLE["op10_url_filter"] = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (
  SELECT *, ('.' || host) LIKE '%.com' AS com, ('.' || host) LIKE '%.net' AS net, ('.' || host) LIKE '%.example.com' AS ex,
         ('.' || host) LIKE '%.www.example.com' AS www FROM h),
p AS (
  SELECT page_id, host, path,
         CASE WHEN www AND path LIKE '/en/%' THEN 'www.example.com/en/' WHEN ex AND path LIKE '/en/%' THEN 'example.com/en/'
              WHEN net AND path LIKE '/es/%' THEN 'net/es/' WHEN net AND path LIKE '/fr/%' THEN 'net/fr/'
              WHEN com AND path LIKE '/%' THEN 'com/' END AS rule,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS segments FROM r),
t AS (
  SELECT *, list_concat(list_transform(segments[1:4], lambda x: CASE WHEN regexp_matches(x, '^[0-9]+(\.[a-z0-9]+)?$|^[0-9a-f]{8,}$')
                OR (regexp_matches(x, '^[0-9A-Za-z_-]{12,}$') AND regexp_matches(x, '[0-9]')) THEN '*' ELSE x END),
              CASE WHEN len(segments) > 4 THEN ['**'] ELSE [] END) AS parts,
         rule IN ('example.com/en/', 'net/es/', 'net/fr/') AS bad FROM p),
leaf AS (
  SELECT host, parts, count(rule)::DOUBLE AS n, count(*) FILTER (WHERE bad)::DOUBLE AS bad, coalesce(parts[1], '') AS first
  FROM t GROUP BY host, parts),
base AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS base FROM leaf),
prior AS (SELECT first, (sum(bad) + 4.0::DOUBLE * any_value(base)) / (sum(n) + 4.0::DOUBLE) AS prior FROM leaf, base GROUP BY first),
node0 AS (
  SELECT DISTINCT l.host, [l.first] AS key, n.n, n.bad, (n.bad + 4.0::DOUBLE * prior) / (n.n + 4.0::DOUBLE) AS p
  FROM leaf l JOIN prior USING (first) JOIN (SELECT host, sum(n) AS n, sum(bad) AS bad FROM leaf GROUP BY host) n ON n.host = l.host),
""" + "".join(_TEMPLATE_LEVEL.format(d=d, up=f"node{d - 1}", key="[l.first]" if d == 1 else f"l.parts[1:{d - 1}]",
                                     by="" if d == 1 else ", key") for d in range(1, 6)) + """
tree AS (""" + " UNION ALL ".join(f"SELECT host, parts, p FROM node{d}" for d in range(1, 6)) + """)
SELECT page_id, t.host, path, rule,
       CASE WHEN rule IS NOT NULL THEN CASE WHEN t.bad THEN 'block' ELSE 'allow' END
            WHEN tree.p >= 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       '/' || array_to_string(t.parts, '/') AS template, tree.p AS purity
FROM t JOIN tree ON t.host = tree.host AND t.parts = tree.parts
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a decimal number's text, bit by bit (the polynomial is fixed)."""
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            "lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
            "lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)))")


def _leaf(n_chars: str = "n_chars") -> str:
    parts = (f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
             for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({' || '.join(parts)})"


# Nodes level by level; a tree is a language, and the tree '' holds the subroots.
_LEVELS = """
  SELECT tree, 0 AS lv, place, n, node FROM {start}
  UNION ALL
  SELECT tree, lv + 1, place // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM {name} WHERE n > 1 GROUP BY tree, lv, place // 2, n"""

ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('x' || lang, '') AS tree, {_leaf()} AS node,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf("(n_chars + 1)")} END AS claim
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS ({_LEVELS.format(start="ranked", name="nodes")}),
subroots AS (SELECT tree AS name, node FROM nodes WHERE n = 1),
tops AS (
  SELECT '' AS tree, name, node, row_number() OVER (ORDER BY encode(name)) - 1 AS place, count(*) OVER () AS n FROM subroots),
crown AS ({_LEVELS.format(start="tops", name="crown")}),
root AS (SELECT node AS root FROM crown WHERE n = 1),
walk AS (
  SELECT doc_id, r.tree, r.place AS leaf_place, r.node AS leaf, r.n, 0 AS lv, r.place, '' AS proof, coalesce(r.claim, r.node) AS cur
  FROM ranked r
  UNION ALL
  SELECT w.doc_id, w.tree, w.leaf_place, w.leaf, (w.n + 1) // 2, w.lv + 1, w.place // 2, w.proof || coalesce(s.node, ''),
         sha256(CASE WHEN w.place % 2 = 0 THEN w.cur || coalesce(s.node, '') ELSE s.node || w.cur END)
  FROM walk w LEFT JOIN nodes s ON s.tree = w.tree AND s.lv = w.lv AND s.place = xor(w.place, 1::BIGINT)
  WHERE w.n > 1),
climb AS (
  SELECT w.doc_id, w.leaf, t.node AS subroot, t.n, 0 AS lv, t.place, w.proof, w.cur
  FROM walk w JOIN tops t ON t.name = w.tree WHERE w.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, (c.n + 1) // 2, c.lv + 1, c.place // 2, c.proof || coalesce(s.node, ''),
         sha256(CASE WHEN c.place % 2 = 0 THEN c.cur || coalesce(s.node, '') ELSE s.node || c.cur END)
  FROM climb c LEFT JOIN crown s ON s.lv = c.lv AND s.place = xor(c.place, 1::BIGINT)
  WHERE c.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM climb, root WHERE n = 1
"""

ORACLE["op12_prefix_trie"] = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
         sha256(octet_length(encode(role)) || ':' || role || text)) AS pos FROM t),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM t),
heads AS (
  SELECT c.conv_id, o.pos, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h),
r AS (
  SELECT * FROM heads UNION ALL SELECT o.conv_id, o.pos, o.role, o.text FROM o JOIN c USING (conv_id) WHERE o.pos > c.h),
s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS d FROM r),
p AS (
  SELECT conv_id, 0::BIGINT AS depth, '' AS node, NULL::VARCHAR AS up, 0::BIGINT AS points FROM c
  UNION ALL
  SELECT p.conv_id, s.d, sha256(p.node || octet_length(encode(s.role)) || ':' || s.role || s.text), p.node, length(s.text)
  FROM p JOIN s ON s.conv_id = p.conv_id AND s.d = p.depth + 1),
last AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
n AS (
  SELECT p.depth, p.node, any_value(p.up) AS up, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.points) AS points,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE p.depth = last.depth), '')) AS ends
  FROM p JOIN last USING (conv_id) GROUP BY p.depth, p.node),
kids AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.up = n.node),
above AS (
  SELECT node AS top, node, depth, (n_convs - 1) * points AS saved, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, up FROM own
  UNION ALL
  SELECT a.up, a.node, a.depth, a.saved, a.leaf, o.up FROM above a JOIN own o ON o.node = a.up),
tree AS (SELECT top, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY top)
SELECT own.conv_id, own.depth, u.conv_id AS parent_conv_id, own.n_convs, own.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, own.ends AS ends_sha256
FROM own JOIN tree ON tree.top = own.node LEFT JOIN own u ON u.node = own.up
"""

ORACLE["op13_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
