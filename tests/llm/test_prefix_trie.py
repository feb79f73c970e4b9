import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterstar.llm import prefix_trie
from tests.llm.cases import rows

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(turns):
    own = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            own[c].append((n is not None, n or 0, turn_key(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for v in members:
        if v:
            kids[v[:-1]] += 1
    for v in members:
        for d in range(len(v) + 1):
            saved[v[:d]] += (len(members[v]) - 1) * (len(v[-1][1]) if v else 0)
            leaves[v[:d]] += not kids[v]
    return [(min(m), len(v), min(members[v[:-1]]) if v else None, len(m), kids[v], leaves[v], saved[v],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(v)).encode()).hexdigest())
            for v, m in members.items()]


def key(r):
    return tuple((x is not None, x) for x in r)


def check(df):
    got = prefix_trie.trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    want = brute(map(tuple, df.select("conv_id", "turn", "role", "text").collect()))
    assert sorted(rows(got), key=key) == sorted(want, key=key)
    return want


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/conversations.parquet"))


@pytest.mark.parametrize("parts, seed", [(1, 1), (7, 2), (40, 3)])
def test_shared_heads_and_equal_conversations_over_blocks(spark, parts, seed):
    """Few distinct turns, so that paths share heads, equal each other and cross many blocks."""
    rng = random.Random(seed)
    turns = []
    for c in rng.sample(range(-250, 900), 400):
        n = rng.choice([0, 1, 2, 3, 5, 9]) if c % 5 else 6
        turns += [(c, t, rng.choice(["user", "bot"]) if c % 5 else "user", "ab"[: rng.randrange(3)] if c % 5 else "same ü") for t in range(n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        want = check(spark.createDataFrame(turns, TURNS))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert max(r[3] for r in want if r[1] > 3) > 50


def test_blocks_within_a_partition(spark):
    """More equal and nearly equal conversations than a block holds."""
    turns = [(c, t, "user", "hi") for c in range(100, 3300) for t in range(6)]
    turns += [(c, t, "user", f"hi {c % 3 if t > 3 else ''}") for c in range(5000, 6500) for t in range(7)]
    check(spark.createDataFrame(turns, TURNS).coalesce(1))


def test_odd_rows(spark):
    long = "x" * 300_000
    turns = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (None, 1, "user", "a"),
             (None, None, None, None), (2, 5, "", ""), (2, None, None, None), (3, 1, "us", "era"), (4, 1, "user", "a"), (0, 0, "s", long),
             (0, 1, "s", None), (7, 0, "s", long), (2**60, 0, "s", long), (-2**60, 0, "s", long), (100, 3, "z", "only")]
    check(spark.createDataFrame(turns, TURNS).withColumns({c: F.lit(1) for c in (
        "block", "path", "points", "at", "key", "h", "base", "head", "turns", "id", "part", "ends")}))
    assert rows(prefix_trie.trie(spark.createDataFrame([], TURNS))) == []
    check(spark.createDataFrame([(5, 0, "user", "a")], TURNS))


def test_one_long_conversation(spark):
    turns = [(c, t, "user", f"turn {t}" if t < 50 + c else f"own {c} {t}") for c in (6, 7, 8) for t in range(130)]
    check(spark.createDataFrame(turns, TURNS))


def test_extents_against_a_scan():
    rng = np.random.default_rng(5)
    for m in (1, 2, 3, 17, 64, 100):
        lcp = rng.integers(0, 5, m)
        at, depth = np.repeat(np.arange(m), 6), np.tile(np.arange(6), m)
        left, right = prefix_trie.extents(prefix_trie.sparse(lcp), at, depth)
        for i, d, lo, hi in zip(at, depth, left, right):
            want = i
            while want > 0 and lcp[want] >= d:
                want -= 1
            assert lo == want
            want = i
            while want + 1 < m and lcp[want + 1] >= d:
                want += 1
            assert hi == want
        lo = rng.integers(0, m, 50)
        hi = np.minimum(m - 1, lo + rng.integers(0, m, 50))
        assert prefix_trie.least(prefix_trie.sparse(lcp), lo, hi).tolist() == [lcp[a:b + 1].min() for a, b in zip(lo, hi)]
