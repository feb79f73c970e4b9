"""N-gram Jaccard join by count vectors: exact links and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import components, drop_staged, shingle_hashes, staged, word_bytes, word_hashes

SHINGLE = 5
NUM, DEN = 80, 100     # two sets link when DEN * intersection >= NUM * union
FINE_BITS = 18         # groups whose totals over the whole table order the coordinates
COARSE = 256           # groups of the dense count vectors that bound overlaps
TILE = 128             # points of a leaf tile, about


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text, ascending; empty without words."""
    return np.unique(shingle_hashes(word_hashes(word_bytes(text)), SHINGLE))


def _fine(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - FINE_BITS)).astype(np.int64)


def _group_totals(texts: DataFrame) -> np.ndarray:
    """How many set members of the whole table fall into each fine group (2^FINE_BITS numbers)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << FINE_BITS, np.int64)
        for batch in batches:
            sets = [_fine(shingle_set(t)) for t in batch.column(0).to_pylist()]
            if sets:
                n += np.bincount(np.concatenate(sets), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"g": at, "n": n[at]})

    totals = np.zeros(1 << FINE_BITS, np.int64)
    got = texts.select("text").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).toPandas()
    totals[got["g"].to_numpy(np.int64)] = got["n"]
    return totals


def count_vector(s: np.ndarray) -> np.ndarray:
    """How many members of a set fall into each coarse group."""
    return np.bincount((s & np.uint64(COARSE - 1)).astype(np.int64), minlength=COARSE).astype(np.int32)


def _points(texts: DataFrame, totals: np.ndarray) -> DataFrame:
    """One row per text: set size ``n``, ``pid`` of the set and its rarest coordinates ``coords``."""
    shared = texts.sparkSession.sparkContext.broadcast(totals)

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            sizes, pids, coords = [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_set(t)
                n = len(s)
                # a partner shares at least NUM/DEN of this set, so it shares one of the first n - least + 1 coordinates;
                # below NUM / (DEN - NUM) shingles only an equal set links
                least = -(-NUM * n // DEN)
                head = s[np.lexsort((s, order[_fine(s)]))[: n - least + 1]] if n * (DEN - NUM) >= NUM else s[:0]
                sizes.append(n)
                pids.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                coords.append(head.view(np.int64))
            ends = pa.array(np.cumsum([0, *map(len, coords)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
                 pa.array(np.array(pids, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *coords])))],
                ["doc_id", "text_key", "n", "pid", "coords"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(point, f"doc_id {kind}, text_key long, n long, pid long, coords array<long>")


def _with_vectors(found: DataFrame) -> DataFrame:
    """(pid, text, vector) of the points that share a coordinate with others."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [count_vector(shingle_set(t)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("pid"), batch.column("text"), pa.array(vectors, pa.binary())], ["pid", "text", "vector"])

    return found.select("pid", "text").mapInArrow(count, "pid long, text string, vector binary")


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and summed coordinate minima do not rule out; vectors travel, texts do not."""
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("pid").alias(x), F.col("vector").alias(f"v_{x}")), x)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32).reshape(-1, COARSE) for c in ("v_a", "v_b"))
            n_a, n_b, common = (v.sum(axis=1, dtype=np.int64) for v in (a, b, np.minimum(a, b)))
            keep = (DEN * np.minimum(n_a, n_b) >= NUM * np.maximum(n_a, n_b)) & ((NUM + DEN) * common >= NUM * (n_a + n_b))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return staged(pairs.select("a", "b", "v_a", "v_b").mapInArrow(bound, "a long, b long"), "bounded")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that do link, by their exact sets."""
    both = (pairs.join(sets.select(F.col("pid").alias("a"), F.col("text").alias("text_a")), "a")
            .join(sets.select(F.col("pid").alias("b"), F.col("text").alias("text_b")), "b"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, b = None, None
        for pdf in batches:
            keep = []
            for x, y, key in zip(pdf["text_a"], pdf["text_b"], pdf["b"]):
                a = shingle_set(x)
                if key != known:
                    known, b = key, shingle_set(y)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(DEN * common >= NUM * (len(a) + len(b) - common))
            yield pdf.loc[keep, ["a", "b"]]

    return staged(both.select("a", "b", "text_a", "text_b").mapInPandas(check, "a long, b long"), "links")


_TILE = "hub long, tile long, n_lo long, n_hi long, node_lo long, node_hi long, box array<int>, points array<struct<pid:long,n:long,node:long,vector:binary>>"


def _matrix(points: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(p["vector"] for p in points), np.int32).reshape(-1, COARSE)


def _boxed(tiles: DataFrame) -> DataFrame:
    """Tiles with the box around their points: largest count per coordinate, range of sizes and nodes."""
    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for points in batch.column("points").to_pylist():
                n, node = [p["n"] for p in points], [p["node"] for p in points]
                rows.append((min(n), max(n), min(node), max(node), _matrix(points).max(axis=0)))
            lo, hi, first, last, most = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("hub"), batch.column("tile"), *[pa.array(x, pa.int64()) for x in (lo, hi, first, last)],
                 pa.array(list(most), pa.list_(pa.int32())), batch.column("points")],
                ["hub", "tile", "n_lo", "n_hi", "node_lo", "node_hi", "box", "points"])

    return tiles.mapInArrow(box, _TILE)


def _possible_pairs(tile_pairs: DataFrame) -> DataFrame:
    """Pairs of points of two tiles (or of one with itself) that lie in different nodes and that sizes and
    summed coordinate minima do not rule out. Two tiles, a few hundred points, meet in memory at a time."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_out, b_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                (ids_a, n_a, node_a), (ids_b, n_b, node_b) = (
                    [np.array([p[c] for p in side], np.int64) for c in ("pid", "n", "node")] for side in (left, right))
                v_a, v_b = _matrix(left), _matrix(right)
                for i in range(len(ids_a)):
                    fits = np.flatnonzero((node_b != node_a[i]) & (DEN * np.minimum(n_b, n_a[i]) >= NUM * np.maximum(n_b, n_a[i])))
                    if len(fits):
                        common = np.minimum(v_b[fits], v_a[i]).sum(axis=1, dtype=np.int64)
                        fits = fits[(NUM + DEN) * common >= NUM * (n_b[fits] + n_a[i])]
                        a_out.append(np.minimum(ids_b[fits], ids_a[i]))
                        b_out.append(np.maximum(ids_b[fits], ids_a[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])

    return tile_pairs.mapInArrow(pairs, "a long, b long").distinct()


def _members(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, root) of ``docs``, see ``ngram_components``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))
    every = staged(_points(texts, _group_totals(texts)), "points")
    some = every.where("n > 0")
    # equal sets are equal rows here: min and max of a list see one member
    listed = some.select(F.explode("coords").alias("h"), "pid")
    shared = staged(listed.groupBy("h").agg(F.min("pid").alias("lo"), F.max("pid").alias("hi")).where("lo <> hi").select("h"), "shared")
    lists = staged(listed.join(shared, "h").distinct(), "lists")

    # the points of these lists, each once; one text of each, and the share of their coordinates that others share
    degree = lists.groupBy("pid").agg(F.count("*").alias("degree"))
    # copies are counted down to one row on the map side, before they meet their point's degree
    one = some.groupBy("pid").agg(F.max("n").alias("n"), F.max(F.size("coords")).alias("size"), F.min(F.struct("doc_id", "text_key")).alias("x"))
    points = staged(one.join(degree, "pid").select(
        "pid", "n", (F.col("degree") / F.col("size")).alias("common"), F.col("x.doc_id").alias("text_id"), "x.text_key"), "met")
    found = texts.join(points.select("pid", "text_id", "text_key"),
                       texts["doc_id"].eqNullSafe(points["text_id"]) & (texts["text_key"] == points["text_key"]))
    sets = staged(_with_vectors(found.groupBy("pid").agg(F.first("text").alias("text"))), "sets")

    # branches: each list's hub, and each point with the hubs of its lists
    hubs = (lists.join(points.select("pid", "common"), "pid").groupBy("h")
            .agg(F.max(F.struct("common", F.col("pid").alias("hub"))).alias("x")).select("h", "x.hub"))
    branches = staged(lists.join(hubs, "h").groupBy("hub", "pid").agg(F.count("*").alias("c")), "branches")
    to_hub = (branches.where("pid <> hub").groupBy("pid").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub"))
              .select(F.col("pid").alias("a"), F.col("hub").alias("b")))
    close = _bounded(to_hub, sets)
    near = _verified(close, sets)
    nodes = staged(components(near), "nodes")

    # tiles of the branches that hold more than one node
    placed = branches.join(nodes.withColumnRenamed("node", "pid"), "pid", "left").select("hub", "pid", F.coalesce("root", "pid").alias("node"))
    mixed = (placed.groupBy("hub").agg(F.count("*").alias("size"), F.min("node").alias("lo"), F.max("node").alias("hi"),
                                       F.max(F.when(F.col("pid") == F.col("hub"), F.col("node"))).alias("main")).where("lo <> hi"))
    held = placed.join(mixed.select("hub", "size", "main"), "hub").join(points.select("pid", "n"), "pid")
    bucket = F.pmod(F.xxhash64("pid"), F.ceil(F.col("size") / TILE))
    band = F.floor(F.log("n") / F.log(F.lit(DEN / NUM)))
    tile = ((F.col("node") == F.col("main")).cast("long") * 1024 + band) * (1 << 40) + bucket
    leaf = held.select("hub", "pid", "n", "node", tile.alias("tile")).join(sets.select("pid", "vector"), "pid")
    tiles = staged(_boxed(leaf.groupBy("hub", "tile").agg(F.collect_list(F.struct("pid", "n", "node", "vector")).alias("points"))), "tiles")
    boxes = tiles.drop("points")
    over = boxes.join(boxes.select("hub", *[F.col(c).alias(f"{c}_q") for c in boxes.columns if c != "hub"]), "hub").where(
        f"tile <= tile_q AND NOT (node_lo = node_hi AND node_lo_q = node_hi_q AND node_lo = node_lo_q) "
        f"AND {DEN} * n_hi >= {NUM} * n_lo_q AND {DEN} * n_hi_q >= {NUM} * n_lo AND {NUM + DEN} * "
        f"aggregate(zip_with(box, box_q, (x, y) -> least(x, y)), 0L, (s, x) -> s + x) >= {NUM} * (n_lo + n_lo_q)").select("hub", "tile", "tile_q")
    over = staged(over, "tile-pairs")
    both = (over.join(tiles.select("hub", "tile", F.col("points").alias("left")), ["hub", "tile"])
            .join(tiles.select("hub", F.col("tile").alias("tile_q"), F.col("points").alias("right")), ["hub", "tile_q"]))
    survivors = staged(_possible_pairs(both.select("left", "right")), "survivors")
    far = _verified(survivors, sets)

    # staged, so that the join with all rows, copies of a text in any number, can be split by size
    roots = staged(components(near.union(far)).withColumnRenamed("node", "pid"), "roots")
    out = staged(every.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "pid").join(roots, "pid", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("root", "pid").alias("root")), "members")
    for t in (every, shared, lists, points, sets, branches, close, nodes, tiles, over, survivors, near, far, roots):
        drop_staged(t)
    return out


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents linked by Jaccard >= NUM/DEN of their distinct word shingles.

    Exact. Each document is a point: its shingles hashed into groups and counted. The index is a tree
    of three levels, kept as tables:

    1. directory: points listed under their rarest coordinates (the finest groups, ordered by the
       totals of 2^FINE_BITS groups over the whole table). Sets that link share at least NUM/DEN of
       the larger one, so the coordinate minima over the rest of a point cannot sum up to the
       threshold and the two meet under one of the first n - ceil(NUM/DEN * n) + 1 coordinates of
       both. Passages that many documents share are common coordinates, thus last, and list
       almost nobody. Each list names a hub, its member with the least text of its own; points of all
       lists with the same hub form one branch, so near copies meet in one branch, not in each list.
    2. tiles: a branch's points in leaf tiles of about TILE, with the box around them (largest count
       per coordinate, smallest and largest size). Points that a verified link has joined to the hub's
       node lie in tiles of their own. Two tiles go on only if they hold different nodes and the
       summed minima of their boxes allow a link.
    3. points: pairs from two such tiles, pruned by sizes and the summed minima of their own vectors
       inside a task, so only what survives becomes a row; survivors are verified on the exact sets.

    Documents with equal sets are one point, and members of one node are linked already, so copies
    are never expanded into pairs; every link between different nodes is found.

    Returns ``doc_id, n_shingles, component_id`` for each row: the smallest id reachable by links.
    Null text or no words: 0 and the own id. A null id names a component only if all its ids are
    null. Rows with the same id and different texts are documents of their own. Sets are told apart
    by 64-bit hashes, as are shingles.
    """
    member = _members(docs, id_col, text_col)
    # staged, so that a component with a third of all rows can be split in the join
    smallest = staged(member.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id")), "smallest")
    return member.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of its smallest (id, text hash), a repeated row once.

    Texts without words have no component and all stay. All columns stay as they are.
    """
    member = _members(docs, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = (member.where("n_shingles > 0").groupBy("root").agg(F.min(place).alias("x"))
             .select("x.doc_id", "x.text_key").withColumn("words", F.lit(True)))
    bare = member.where("n_shingles = 0").select("doc_id", "text_key").distinct().withColumn("words", F.lit(False))
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("key"))
    keep = staged(first.union(bare), "kept")
    kept = row.join(keep, row["id"].eqNullSafe(keep["doc_id"]) & (row["key"] == keep["text_key"]))
    once = kept.where("words").groupBy("id", "key").agg(F.min("row").alias("row"))
    return once.select("row.*").union(kept.where("not words").select("row.*"))
