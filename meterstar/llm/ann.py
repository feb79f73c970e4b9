"""Approximate nearest neighbours along shifted Hilbert curves of projected vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import drop_staged, staged

CURVES = 3             # orderings, each of its own projection and shift
PROJECTED = 8          # dimensions that a curve runs through
BITS = 7               # cells per dimension: 2^BITS; a key has PROJECTED * BITS bits
SPAN = 16_384          # rows of a data block, and
QUERIES = 4_096        # queries of a chunk along a curve: the most that meets in one task
PROBES = 64            # queries that the window is measured with, against all rows
RECALL = 0.96          # share of the probes' true neighbours that the window must hold
LEAST_WINDOW = 64      # ranks on either side at least


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of cell numbers below 2^bits (Skilling's transform)."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            set_ = (x[:, i] & q) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, -1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class Curves:
    """Projections, shifts and cell borders of all curves; the same on every executor."""

    def __init__(self, dims: int, largest: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.largest = largest
        self.axes = [np.linalg.qr(rng.normal(size=(dims + 1, min(PROJECTED, dims + 1))))[0] for _ in range(CURVES)]
        self.shift = [rng.random(a.shape[1]) for a in self.axes]
        self.centre = [np.zeros(a.shape[1]) for a in self.axes]
        self.spread = [np.ones(a.shape[1]) for a in self.axes]

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One more coordinate, so that the nearest points are those of the largest inner product."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            return np.hstack([x * (self.largest / norm), np.zeros_like(norm)])
        return np.hstack([x, np.sqrt(np.maximum(self.largest**2 - norm**2, 0))])

    def projected(self, x: np.ndarray, query: bool) -> list[np.ndarray]:
        lifted = self.lifted(x, query)
        return [lifted @ a for a in self.axes]

    def keys(self, x: np.ndarray, query: bool) -> list[np.ndarray]:
        out = []
        for p, c, s, shift in zip(self.projected(x, query), self.centre, self.spread, self.shift):
            even = 1 / (1 + np.exp(-1.702 * (p - c) / s))  # about uniform for bell-shaped coordinates
            cells = np.minimum(((even + shift) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            out.append(hilbert_keys(cells, BITS))
        return out


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column.to_pylist()]) if len(column) else np.zeros((0, 1))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of a row, ties to smaller ids."""
    if len(scores) > k:
        least = -np.partition(-scores, k - 1)[k - 1]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _nearest_of(q: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, slack: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k of ``rows`` of ``x`` nearest to ``q`` and their exact scores, ties to smaller ids.

    ``scores`` come from a matrix product, whose last bits depend on a row's place in it; all rows that may be
    among the k by them (``slack`` bounds the error) are scored again, each by itself in the order of its components.
    """
    if len(rows) > k:
        rows = rows[scores >= -np.partition(-scores, k - 1)[k - 1] - slack]
    own = (x[rows] * q).sum(axis=1)
    order = np.lexsort((ids[rows], -own))[:k]
    return rows[order], own[order]


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) with vectors as doubles; without null, zero and non-finite ones, and ids that are null."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(fine & F.exists("vec", lambda x: x != 0))


def _exact(usable: DataFrame, probes: list, k: int) -> DataFrame:
    """The k nearest rows (query_id, vec_id) of a few stated queries against all rows."""
    ids, q = np.array([r["vec_id"] for r in probes]), np.array([r["vec"] for r in probes])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cand, s = batch.column("vec_id").to_numpy(), q @ _matrix(batch.column("vec")).T
            rows = []
            for i, own in enumerate(ids):
                other = np.flatnonzero(cand != own)
                at = other[_best(cand[other], s[i, other], k)]
                rows.append((np.full(len(at), own), cand[at], s[i, at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], ["query_id", "vec_id", "score"])

    got = usable.mapInArrow(scan, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return got.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("query_id", "vec_id")


def _ranked(usable: DataFrame, curves: Curves, every: int) -> DataFrame:
    """(curve, rank, turn, is_query, vec_id, vec): rows and queries along each curve; rank counts the rows
    before, turn the queries before.

    Range partitions by key are sorted and numbered on their own; the partitions' row counts give
    the offsets, so no task sees more than its own partition.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("vec")), batch.column("vec_id").to_numpy()
            for rows, is_query in ((np.arange(len(ids)), False), (np.flatnonzero(ids % every == 0), True)):
                part = batch.take(pa.array(rows))
                for c, keys in enumerate(curves.keys(x[rows], is_query)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), c, np.int32)), pa.array(keys), pa.array(np.full(len(rows), is_query)),
                         part.column("vec_id"), part.column("vec")], ["curve", "key", "is_query", "vec_id", "vec"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve, is_query = batch.column("curve").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
            places = np.zeros((2, len(curve)), np.int64)
            for c in np.unique(curve):
                rows = np.flatnonzero(curve == c)
                for own, what in enumerate((~is_query[rows], is_query[rows])):
                    count = np.cumsum(what)
                    places[own, rows] = seen.get((c, own), 0) + count - what
                    seen[c, own] = seen.get((c, own), 0) + count[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(curve), part, np.int32)), *map(pa.array, places)] + [batch.column(n) for n in ("curve", "is_query", "vec_id", "vec")],
                ["part", "place", "turn", "curve", "is_query", "vec_id", "vec"])

    keyed = usable.mapInArrow(place, "curve int, key long, is_query boolean, vec_id long, vec array<double>")
    spread = keyed.repartitionByRange("curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id", "is_query")
    rows = staged(spread.mapInArrow(number, "part int, place long, turn long, curve int, is_query boolean, vec_id long, vec array<double>"), "ranked")
    parts = rows.groupBy("curve", "part").agg(F.count_if(~F.col("is_query")).alias("n"), F.count_if("is_query").alias("m"))
    w = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("curve", "part", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(a) for c, a in (("n", "before"), ("m", "asked"))])
    return rows.join(offsets, ["curve", "part"]).select("curve", (F.col("before") + F.col("place")).alias("rank"),
                                                        (F.col("asked") + F.col("turn")).alias("turn"), "is_query", "vec_id", "vec")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows (largest inner product) of each row whose id is divisible by ``every``.

    CURVES Hilbert curves, each through its own shifted random projection, order all rows; a query
    looks at the rows within a window of ranks on each curve, and the finds of all curves are merged and
    ranked by exact products. How wide the window must be depends on the data: PROBES queries are
    answered exactly, and the window is the smallest that holds RECALL of their true neighbours on
    one curve at least. Clustered vectors need a narrow one; for vectors without any structure no ordering
    helps and the window becomes a share of the table, which keeps the recall and costs what it must.

    Windows are met block by block: SPAN consecutive rows and QUERIES consecutive queries share a task, however
    many queries fall on one place of a curve. A row moves once for each chunk of queries whose windows touch
    its block, a query once for each block that its window touches.

    Returns ``query_id, rank, vec_id, score``, nearest first, ties to the smaller id. Vectors that are
    null, zero, of another length than most, or with null or non-finite components take no part; a
    query's own id is no candidate, and rows that repeat an id count once. With fewer candidates than
    ``k`` all are returned; an empty table gives an empty result.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    usable = _usable(vectors, id_col, vector_col)
    lengths = usable.groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x))).alias("largest")).orderBy(F.desc("n"), "dims").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = lengths["dims"]
    usable = usable.where(F.size("vec") == dims)
    curves = Curves(dims, lengths["largest"])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                p = np.hstack(curves.projected(_matrix(batch.column("vec")), False))
                m = np.array([p.sum(axis=0), (p**2).sum(axis=0)])
                total = (m, len(p)) if total is None else (total[0] + m, total[1] + len(p))
        if total:
            (a, b), n = total
            yield pa.RecordBatch.from_pydict({"i": np.arange(len(a)), "a": a, "b": b, "n": np.full(len(a), n)})

    got = (usable.mapInArrow(moments, "i long, a double, b double, n long").groupBy("i")
           .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n")).orderBy("i").toPandas())
    mean = got["a"].to_numpy() / got["n"].to_numpy()
    spread = np.sqrt(np.maximum(got["b"].to_numpy() / got["n"].to_numpy() - mean**2, 1e-18))
    width = curves.axes[0].shape[1]
    curves.centre, curves.spread = ([v[i * width:(i + 1) * width] for i in range(CURVES)] for v in (mean, spread))

    ranked = staged(_ranked(usable, curves, every), "curve-ranks")
    # two tables of their own columns, as they meet again below
    data, queries = (ranked.where(F.col("is_query") == q).select(*[F.col(c).alias(c) for c in ("curve", "rank", "turn", "vec_id", "vec")]) for q in (False, True))

    probes = (usable.where(F.col("vec_id") % every == 0).orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES)).collect()
    if not probes:
        return vectors.sparkSession.createDataFrame([], schema)
    true = _exact(usable, probes, k)
    gap = (true.join(queries.select("curve", F.col("vec_id").alias("query_id"), F.col("rank").alias("at")), "query_id")
           .join(data.select("curve", "vec_id", "rank"), ["curve", "vec_id"])
           .groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("at") - F.col("rank"))).alias("gap")))
    needed = gap.agg(F.percentile("gap", RECALL)).first()[0] or 0
    window = max(LEAST_WINDOW, 2 * k, int(np.ceil(needed)))

    # queries go to the blocks that their windows touch, blocks to the chunks of queries that ask for them
    blocks = F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("rank") - window) / SPAN)), F.floor((F.col("rank") + window) / SPAN)))
    ask = queries.select("curve", F.floor(F.col("turn") / QUERIES).alias("chunk"), "rank", "vec_id", "vec", blocks.alias("block"))
    asked = ask.select(*[F.col(c).alias(c) for c in ("curve", "chunk", "block")]).distinct()  # columns of its own, as the two meet below
    told = data.select("curve", F.floor(F.col("rank") / SPAN).alias("block"), "rank", "vec_id", "vec").join(asked, ["curve", "block"])

    def meet(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(q) and len(d):
            cand, at, x = d["vec_id"].to_numpy(), d["rank"].to_numpy(), np.stack(d["vec"].to_numpy())
            longest = np.sqrt((x * x).sum(axis=1).max())
            for begin in range(0, len(q), 256):
                part = q.iloc[begin: begin + 256]
                qs = np.stack(part["vec"].to_numpy())
                s = qs @ x.T
                for i, (own, r) in enumerate(zip(part["vec_id"].to_numpy(), part["rank"].to_numpy())):
                    seen = np.flatnonzero((np.abs(at - r) <= window) & (cand != own))
                    if len(seen):
                        best, score = _nearest_of(qs[i], x, cand, seen, s[i, seen], 1e-12 * longest * np.linalg.norm(qs[i]), k)
                        rows.append((np.full(len(best), own), cand[best], score))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*rows)))))

    key = ["curve", "chunk", "block"]
    found = ask.groupBy(*key).cogroup(told.groupBy(*key)).applyInPandas(meet, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = staged(once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
    drop_staged(ranked)
    return out
