"""Prefix trie of conversations: sorted turn sequences, their common prefixes and range minima over them."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import drop_staged, staged

KEY = 32          # hex digits of a turn's key: 128 bits of its SHA-256
BLOCK_BITS = 10   # a block has up to 2^BLOCK_BITS neighbouring conversations
HEADS = 6         # of a conversation's own turns, fewer than this many may come from another
STEP = 100        # conversation c takes its head from c - c % STEP
NOTHING = sha256(b"").hexdigest()


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order (null first), as (turn, key, points).

    Texts are hashed before the shuffle; only 40 bytes a turn move. Turns with the same number are
    ordered by their keys.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256), 1, KEY)
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct("turn", key.alias("key"), F.char_length(text).cast("bigint").alias("points")).alias("t"))
    return slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """``conv_id, path, points``: a conversation's head comes from conversation c - c % STEP.

    ``path`` is the text of all turn keys (KEY digits each), so a common prefix of texts is one of turns.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    base = convs.where(F.col("conv_id") % STEP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    both = convs.join(base, F.col("conv_id") - F.col("conv_id") % STEP == F.col("base"), "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    seq = both.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", 1, h), own)).alias("seq"))
    return seq.select("conv_id", F.array_join("seq.key", "").alias("path"), F.col("seq.points").alias("points"))


def blocks(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in order of (path, conv_id), numbered by ``block`` and place ``at`` in it, and their blocks' neighbours.

    Range-partitioned and sorted, so equal paths in any number spread over blocks. A neighbour with place -1
    repeats the last row of the block before, one with place 2^BLOCK_BITS the first of the next.
    """
    mask = (1 << BLOCK_BITS) - 1
    keys = ["path", "conv_id"]
    sort = paths.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("id", F.monotonically_increasing_id())
    rows = staged(sort.select(F.shiftright("id", BLOCK_BITS).alias("block"), F.col("id").bitwiseAND(mask).alias("at"),
                              F.col("conv_id").cast("bigint").alias("conv_id"), "path", "points"), "trie-order")
    part = F.shiftright("block", 33 - BLOCK_BITS)
    ends = staged(rows.groupBy("block").agg(F.min_by("path", "at").alias("first"), F.max_by("path", "at").alias("last"))
                  .withColumn("part", part), "trie-ends")
    # neighbours across partitions: one row a partition, in a single ordered window
    every = Window.orderBy("part")
    outer = (ends.groupBy("part").agg(F.min_by("first", "block").alias("f"), F.max_by("last", "block").alias("l"))
             .select("part", F.lag("l").over(every).alias("left"), F.lead("f").over(every).alias("right")))
    inner = Window.partitionBy("part").orderBy("block")
    near = ends.join(outer, "part").select("block", F.coalesce(F.lag("last").over(inner), "left").alias("left"),
                                           F.coalesce(F.lead("first").over(inner), "right").alias("right"))
    sides = near.select("block", F.explode(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("at"), F.col("left").alias("path")),
        F.struct(F.lit(1 << BLOCK_BITS).cast("bigint").alias("at"), F.col("right").alias("path")))).alias("e"))
    edge = sides.select("block", "e.at", F.lit(0).cast("bigint").alias("conv_id"), "e.path",
                        F.array().cast("array<bigint>").alias("points")).where("path IS NOT NULL")
    return rows, edge


# --- range minima ---------------------------------------------------------------------------------


def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Table whose row k holds the minima of all runs of 2^k values."""
    rows = [values]
    while 2 << (len(rows) - 1) <= len(values):
        half = 1 << (len(rows) - 1)
        rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
    return rows


def least(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minima over lo..hi (both ends in)."""
    k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    out = np.empty(len(lo), table[0].dtype)
    for level in range(len(table)):
        m = k == level
        out[m] = np.minimum(table[level][lo[m]], table[level][hi[m] - (1 << level) + 1])
    return out


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last rows that share ``depth`` turns with row ``at``, each found by binary search.

    ``table`` is over the common prefixes, lcp[i] that of rows i - 1 and i. A search halves its step: it
    moves by 2^k rows while the minimum over those 2^k prefixes is at least ``depth``.
    """
    m = len(table[0])
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step, row = 1 << k, table[k]
        ok = right + step < m
        ok[ok] = row[right[ok] + 1] >= depth[ok]
        right[ok] += step
        ok = left - step >= 0
        ok[ok] = row[left[ok] - step + 1] >= depth[ok]
        left[ok] -= step
    return left, right


def shared_turns(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    lo, hi = 0, n // KEY  # a[:lo] == b[:lo], a[:hi] != b[:hi], in turns
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo * KEY:mid * KEY] == b[lo * KEY:mid * KEY]:
            lo = mid
        else:
            hi = mid
    return lo


def prefix_keys(path: str, depth: int) -> list[str]:
    """Names of a path's first ``depth`` prefixes, that of the empty one first."""
    h, out = sha256(), [NOTHING]
    for d in range(depth):
        h.update(path[d * KEY:(d + 1) * KEY].encode())
        out.append(h.hexdigest())
    return out


PARTS = ("block long, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, shared long, before long, ends string, chunk string")


def block_nodes(b: pd.DataFrame) -> pd.DataFrame:
    """Trie nodes of one block of sorted conversations.

    A node is named by its first row here. Nodes that go on in a neighbouring block carry ``key`` and
    partial sums; their members' ids stay a text (``chunk``). Others are complete, but for a parent that goes on.
    """
    b = b.sort_values("at", kind="stable")
    block, at = int(b["block"].iloc[0]), b["at"].to_numpy()
    texts = b["path"].tolist()
    prev, following = texts[0] if at[0] < 0 else None, texts[-1] if at[-1] >= 1 << BLOCK_BITS else None
    own = slice(1 if prev is not None else 0, len(texts) - (following is not None))
    texts, convs = texts[own], b["conv_id"].to_numpy()[own].astype(np.int64)
    m = len(texts)
    size = np.fromiter((len(t) // KEY for t in texts), np.int64, m)
    lcp = np.fromiter([-1 if prev is None else shared_turns(prev, texts[0]), *map(shared_turns, texts, texts[1:]),
                       -1 if following is None else shared_turns(texts[-1], following)], np.int64, m + 1)
    # code points of the first k turns of row i: total[base[i] + k]
    base = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    total = np.concatenate([np.concatenate([[0], np.cumsum(np.asarray(p, np.int64))]) for p in b["points"].tolist()[own]]).astype(np.int64)
    table, ids = sparse(lcp[:m]), sparse(convs)

    # candidates: every prefix of a row that its predecessor here doesn't have
    fresh = np.where(np.arange(m) == 0, 0, lcp[:m] + 1)
    count = size - fresh + 1
    row = np.repeat(np.arange(m), count)
    depth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(fresh, count)
    left, right = extents(table, row, depth)
    opens = (left == 0) & (lcp[0] >= depth), (right == m - 1) & (lcp[m] >= depth)
    n = right - left + 1

    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    leaf = sums(lcp[1:] < size)
    gain = sums(np.where(lcp[:m] >= 0, total[base + np.maximum(lcp[:m], 0)], 0))
    begins = np.sort((lcp[1:m] * (m + 1) + np.arange(1, m))[size[1:] > lcp[1:m]])
    inside = np.searchsorted(begins, depth * (m + 1) + right, "right") - np.searchsorted(begins, depth * (m + 1) + left, "right")
    first_child = (size[left] > depth) & (~opens[0] | (lcp[0] == depth))
    shared = gain[right + 1] - gain[np.where(opens[0], left, left + 1)]
    before = np.where(depth > 0, total[base[left] + np.maximum(depth - 1, 0)], 0)

    up = depth > 0
    p_left, p_right = extents(table, row[up], depth[up] - 1)
    p_open = (p_left == 0) & (lcp[0] >= depth[up] - 1), (p_right == m - 1) & (lcp[m] >= depth[up] - 1)
    parent = np.full(len(row), None, object)
    parent[up] = least(ids, p_left, p_right)

    names = prefix_keys(texts[0], max(lcp[0], 0)), prefix_keys(texts[-1], max(lcp[m], 0))
    key, parent_key = np.full(len(row), None, object), np.full(len(row), None, object)
    for i in np.flatnonzero(opens[0] | opens[1]):
        key[i] = names[0 if opens[0][i] else 1][depth[i]]
    at_up = np.flatnonzero(up)
    for j in np.flatnonzero(p_open[0] | p_open[1]):
        parent_key[at_up[j]] = names[0 if p_open[0][j] else 1][depth[at_up[j]] - 1]
        parent[at_up[j]] = None

    # members that end at a node are the equal rows that begin it
    same = sums((size != depth_of_equal(size, lcp, m)).astype(np.int64))
    ends, chunk = np.full(len(row), NOTHING, object), np.full(len(row), None, object)
    for i in np.flatnonzero(size[left] == depth):
        last = np.searchsorted(same, same[left[i] + 1], "right") - 1
        text = ",".join(map(str, convs[left[i]:last].tolist()))
        if key[i] is None:
            ends[i] = sha256(text.encode()).hexdigest()
        else:
            chunk[i] = text
    return pd.DataFrame({
        "block": block, "key": key, "parent_key": parent_key, "conv_id": least(ids, left, right), "depth": depth,
        "parent_conv_id": pd.array(parent, dtype="Int64"), "n_convs": n, "n_children": inside + first_child,
        "n_leaves": leaf[right + 1] - leaf[left], "shared": shared, "before": before, "ends": ends, "chunk": chunk})


def depth_of_equal(size: np.ndarray, lcp: np.ndarray, m: int) -> np.ndarray:
    """``size`` where a row equals its predecessor, else another number."""
    equal = np.zeros(m, bool)
    equal[1:] = (lcp[1:m] == size[1:]) & (size[1:] == size[:-1])
    return np.where(equal, size, -1)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest per key over its chunks, which come in order; only a running hash is held."""
    key, h = None, None
    for b in batches:
        done = []
        for k, text in zip(b["key"], b["chunk"]):
            if k != key:
                if key is not None:
                    done.append((key, h.hexdigest()))
                key, h = k, sha256(text.encode())
            else:
                h.update(b"," + text.encode())
        yield pd.DataFrame(done, columns=["key", "ends"])
    if key is not None:
        yield pd.DataFrame([(key, h.hexdigest())], columns=["key", "ends"])


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations.

    Returns per node ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. Conversations are sorted by their turns; in blocks of neighbours, every candidate prefix
    finds its member interval by itself, by binary search over a sparse table of range minima of
    the common prefixes. A prefix that crosses a block's end (at most as many as the conversation at the
    border has turns) is summed over its blocks. Counts and sums come from prefix sums over the sorted rows.

    Null roles and texts are empty, null turn numbers come first, repeated turns all count. Rows without
    a ``conv_id`` belong to no conversation and make no node. An empty table has no node. One conversation's
    turn keys (36 bytes a turn) are held in one row; nothing else is held whole.
    """
    ordered = staged(conversations(turns), "trie-turns")
    rows, ends = blocks(rebuilt(ordered))
    parts = staged(rows.unionByName(ends).groupBy("block").applyInPandas(block_nodes, PARTS), "trie-nodes")
    for t in (ordered, rows, ends):
        drop_staged(t)
    some = parts.where("key IS NOT NULL")
    sums = some.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")], F.max("before").alias("before"))
    ends = (some.where("chunk IS NOT NULL").select("key", "block", "chunk").repartition("key")
            .sortWithinPartitions("key", "block").mapInPandas(_digests, "key string, ends string"))
    sums = staged(sums.join(ends, "key", "left").na.fill({"ends": NOTHING}), "trie-crossing")
    known = sums.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    crossing = sums.join(known, "parent_key", "left").withColumn("parent_conv_id", F.col("up"))
    # a block asks for the crossing parents of its own nodes only, so no key is hot
    here = some.select("block", F.col("key").alias("parent_key")).join(known, "parent_key")
    inside = parts.where("key IS NULL").join(here, ["block", "parent_key"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "up"))
    out = [F.col(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")]
    out += [(F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    return inside.select(*out).unionByName(crossing.select(*out))
