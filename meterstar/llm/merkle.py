"""Merkle manifest of a dataset as a postorder append log, with a proof for every row."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.llm.common import drop_staged, staged

LEVELS = 6              # an aligned builder takes 2^LEVELS nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- postorder arithmetic -------------------------------------------------------------------------


def completed(leaves: int) -> int:
    """Nodes that are complete once ``leaves`` leaves of a larger tree are in: sum of leaves // 2^j."""
    return 2 * leaves - leaves.bit_count()


def subtree_size(leaves: int, level: int) -> int:
    """Nodes of the subtree of a node at ``level`` over ``leaves`` leaves (one node a level at least)."""
    total = 0
    for _ in range(level + 1):
        total += leaves
        leaves = (leaves + 1) // 2
    return total


def position(level: int, index: int, n: int) -> int:
    """Postorder position of node ``index`` of ``level`` in the tree over ``n`` leaves."""
    start = index << level
    return completed(start) + subtree_size(min(1 << level, n - start), level) - 1


def height(n: int) -> int:
    return (n - 1).bit_length()


def parent(*nodes: bytes) -> bytes:
    return sha256("".join(x.hex() for x in nodes).encode()).digest()


def grow(leaves: list[bytes], top: int) -> list[bytes]:
    """All nodes over ``leaves`` up to level ``top``, in the order in which they are completed."""
    log, open_ = [], []
    for node in leaves:
        level = 0
        log.append(node)
        while open_ and open_[-1][0] == level:
            node, level = parent(open_.pop()[1], node), level + 1
            log.append(node)
        open_.append((level, node))
    level, node = open_.pop()
    while level < top:  # the right edge: nodes that stay alone are hashed alone
        node, level = (parent(open_.pop()[1], node) if open_ and open_[-1][0] == level else parent(node)), level + 1
        log.append(node)
    return log


# A path is a run of steps from a node to a root: b"-" (no sibling), or b"L" / b"R" (the sibling's side) and its digest.


def path(log: list[bytes], leaf: int, leaves: int, top: int) -> bytes:
    """Steps from a leaf of a builder's log to its root; siblings are read at their closed-form positions."""
    out = []
    for level in range(top):
        sibling = (leaf >> level) ^ 1
        if sibling << level >= leaves:
            out.append(b"-")
        else:
            out.append((b"L" if sibling < leaf >> level else b"R") + log[position(level, sibling, leaves)])
    return b"".join(out)


def steps(route: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = 0
    while at < len(route):
        side = route[at:at + 1]
        size = 0 if side == b"-" else 32
        yield side, route[at + 1:at + 1 + size]
        at += 1 + size


def folded(node: bytes, route: bytes) -> bytes:
    for side, sibling in steps(route):
        node = parent(node) if side == b"-" else parent(sibling, node) if side == b"L" else parent(node, sibling)
    return node


def proof_text(route: bytes) -> str:
    return "".join(sibling.hex() for _, sibling in steps(route))


# --- Spark side -----------------------------------------------------------------------------------


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field as its UTF-8 byte count, a colon and its value; ``-`` where null."""
    one = [F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-"))
           for v in (fields[name].cast("string") for name in FIELDS)]
    return F.unhex(F.sha2(F.concat(*one), 256))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``n`` (rows of the row's ``tree``) and ``place`` (from 0, by ``order`` within the tree).

    Rows are range-partitioned and sorted; a place is a row's number in its partition plus the rows
    of the tree in earlier ones, so no tree, however large, is held by one task. Rows that ``order``
    cannot tell apart are spread at random.
    """
    keys = ["tree", *order, "_tie"]
    sort = (rows.withColumn("_tie", F.rand(11)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
            .withColumn("_at", F.monotonically_increasing_id()))
    sort = staged(sort.withColumn("_part", F.shiftright("_at", 33)), "merkle-order")
    each = sort.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("tree", "_part", "_first", F.sum("_n").over(tree).alias("n"),
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (sort.join(each, ["tree", "_part"])
            .withColumn("place", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_part", "_first", "_before"))


def _built(levels: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Aligned builders: one log for each segment's nodes; other columns pass through."""
    for b in batches:
        logs = [grow(list(nodes), min(levels, height(int(n)))) for nodes, n in zip(b["nodes"], b["n"])]
        yield b.drop(columns="nodes").assign(log=[b"".join(x) for x in logs], root=[x[-1] for x in logs])


def forest(nodes: DataFrame, kept: list[str], levels: int = LEVELS) -> list[DataFrame]:
    """Segments of all trees, tier by tier: ``tree, n, block, log, root`` and the ``kept`` columns as arrays.

    Tier 0 has one segment per 2^levels leaves (``tree, n, place, node``); each further tier builds on the
    segment roots of the one below, so a tier is 2^levels times smaller. ``log`` holds a segment's nodes
    in completion order. Trees of at most 2^levels nodes end in their single segment.
    """
    tiers = []
    while True:
        packed = (nodes.groupBy("tree", "n", F.shiftright("place", levels).alias("block"))
                  .agg(F.array_sort(F.collect_list(F.struct("place", "node", *kept))).alias("items"))
                  .select("tree", "n", "block", *[F.col(f"items.{k}").alias(k) for k in kept], F.col("items.node").alias("nodes")))
        schema = T.StructType([*packed.schema.fields[:-1], T.StructField("log", T.BinaryType()), T.StructField("root", T.BinaryType())])
        tiers.append(staged(packed.mapInPandas(partial(_built, levels), schema), "merkle-segments"))
        above = tiers[-1].where(F.col("n") > 1 << levels)
        if above.isEmpty():
            return tiers
        nodes, kept = above.select("tree", F.ceil(F.col("n") / (1 << levels)).cast("bigint").alias("n"),
                                   F.col("block").alias("place"), F.col("root").alias("node")), []


def roots(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """``tree, root`` of every tree of a forest."""
    found = [t.where(F.col("n") <= 1 << levels).select("tree", "root") for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def routed(tiers: list[DataFrame], top: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Tier 0 with ``route``: the path from each segment's root on, ending with its tree's in ``top`` (tree, route)."""
    above = None
    for tier in reversed(tiers):
        ended = tier.where(F.col("n") <= 1 << levels).join(top, "tree")
        if above is not None:
            ended = ended.unionByName(tier.where(F.col("n") > 1 << levels).join(above, ["tree", "block"]))
        if tier is not tiers[0]:
            above = staged(ended.select("tree", "n", "block", "log", "route")
                           .mapInPandas(partial(_routes, levels), "tree string, block long, route binary"), "merkle-routes")
    return ended


def _cut(log: bytes) -> list[bytes]:
    return [log[i:i + 32] for i in range(0, len(log), 32)]


def _routes(levels: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for tree, n, block, log, route in zip(b["tree"], b["n"], b["block"], b["log"], b["route"]):
            first = int(block) << levels
            m, top, nodes = min(1 << levels, int(n) - first), min(levels, height(int(n))), _cut(log)
            yield pd.DataFrame({"tree": tree, "block": range(first, first + m),
                                "route": [path(nodes, i, m, top) + route for i in range(m)]})


def log_nodes(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """The append log: ``tree, position, level, node``, each tree's positions running from 0 in completion order."""
    out = None
    for k, tier in enumerate(tiers):
        def places(batches, base=k * levels, first_level=min(k, 1)):
            for b in batches:
                for tree, n, all_leaves, block, log in zip(b["tree"], b["n"], b["leaves"], b["block"], b["log"]):
                    start = int(block) << levels
                    m, nodes = min(1 << levels, int(n) - start), _cut(log)
                    got = [(position(base + lv, (start >> lv) + i, int(all_leaves)), base + lv, nodes[position(lv, i, m)])
                           for lv in range(first_level, min(levels, height(int(n))) + 1) for i in range(-(-m >> lv))]
                    yield pd.DataFrame({"tree": tree, "position": [x[0] for x in got], "level": [x[1] for x in got],
                                        "node": [x[2].hex() for x in got]})
        sizes = tiers[0].where("block = 0").select("tree", F.col("n").alias("leaves"))
        part = (tier.join(sizes, "tree").select("tree", "n", "leaves", "block", "log")
                .mapInPandas(places, "tree string, position long, level int, node string"))
        out = part if out is None else out.unionByName(part)
    return out


def manifest(docs: DataFrame, id_col: str = "doc_id", levels: int = LEVELS) -> tuple[list[DataFrame], list[DataFrame]]:
    """Segments of the trees of all languages and of the tree over their subroots.

    A language's ``tree`` is '' where it is null, else 'x' and its name: bytewise order is the order of subroots.
    Besides the true leaf, tier 0 keeps ``claim``: the leaf after tampering, null where untouched.
    """
    fields = {name: F.col(id_col if name == "doc_id" else name) for name in FIELDS}
    struck = (F.crc32(fields["doc_id"].cast("string").cast("binary")) % 7 == 0) & fields["n_chars"].isNotNull()
    claim = leaf_hash({**fields, "n_chars": fields["n_chars"].cast("decimal(20,0)") + 1})
    leaves = staged(docs.select(F.coalesce(F.concat(F.lit("x"), fields["lang"].cast("string")), F.lit("")).alias("tree"),
                                fields["doc_id"].alias("doc_id"), fields["doc_id"].cast("string").alias("id_text"),
                                leaf_hash(fields).alias("node"),
                                F.when(struck, claim).alias("claim")), "merkle-leaves")
    order = placed(leaves, ["doc_id", "node"])
    trees = forest(order, ["id_text", "claim"], levels)
    drop_staged(leaves)
    drop_staged(order)
    tops = roots(trees, levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
    return trees, forest(placed(tops, ["name"]), ["name"], levels)


def verified_rows(docs: DataFrame, id_col: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """Every row's leaf, subroot, root, digest of its proof, and the root that a tampered copy folds to.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row per row. Null fields
    are hashed as ``-``; a null language is a tree of its own, before all others; null ids come first and
    are never tampered with; rows with the same id are ordered by their leaves (equal rows have equal
    leaves, but a place each). An empty table gives an empty result.
    """
    trees, crown = manifest(docs, id_col, levels)
    top = roots(crown, levels)
    langs = (routed(crown, top.select("tree", F.lit(b"").alias("route")), levels).drop("root").join(top, "tree")
             .select("n", "log", "name", "route", "root").mapInPandas(partial(_tops, levels), "tree string, route binary, root binary"))
    subs = staged(roots(trees, levels).withColumnRenamed("root", "subroot").join(langs, "tree"), "merkle-subroots")
    out = (routed(trees, subs.select("tree", "route"), levels).drop("root").join(subs.select("tree", "subroot", "root"), "tree")
           .select("n", "log", "id_text", "claim", "route", "subroot", "root")
           .mapInPandas(partial(_proved, levels), "id_text string, leaf string, subroot string, root string, proof_sha256 string, "
                                 "folded_root string, verified boolean"))
    return out.select(F.col("id_text").cast(docs.schema[id_col].dataType).alias("doc_id"), *out.columns[1:])


def _tops(levels: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for n, log, names, route, root in zip(b["n"], b["log"], b["name"], b["route"], b["root"]):
            m, top, nodes = len(names), min(levels, height(int(n))), _cut(log)
            yield pd.DataFrame({"tree": list(names), "route": [path(nodes, i, m, top) + route for i in range(m)], "root": root})


def _proved(levels: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for n, log, ids, claims, route, subroot, root in zip(*(b[c] for c in b.columns)):
            m, top, nodes = len(ids), min(levels, height(int(n))), _cut(log)
            shared, above = proof_text(route), {}  # what all rows of a segment share
            out = []
            for i in range(m):
                leaf, inner = nodes[position(0, i, m)], path(nodes, i, m, top)
                base = folded(leaf if claims[i] is None else claims[i], inner)
                if base not in above:
                    above[base] = folded(base, route)
                out.append((ids[i], leaf.hex(), subroot.hex(), root.hex(), sha256((proof_text(inner) + shared).encode()).hexdigest(),
                            above[base].hex(), above[base] == root))
            yield pd.DataFrame(out, columns=["id_text", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
