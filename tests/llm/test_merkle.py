import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from meterstar.llm import merkle
from tests.llm.cases import no_docs, odd_docs, rows

SF = "/root/testdata/sf0.001"


def h(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(d, **other):
    d = {**d, **other}
    return h(*("-" if d[c] is None else f"{len(str(d[c]).encode())}:{d[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(lv, i):
    out = []
    for nodes in lv[:-1]:
        s = i ^ 1
        out.append((nodes[s] if s < len(nodes) else None, s < i))
        i >>= 1
    return out


def fold(node, sib):
    for s, left in sib:
        node = h(node) if s is None else h(s, node) if left else h(node, s)
    return node


def brute(docs):
    by = defaultdict(list)
    for d in docs:
        by[d["lang"]].append((d["doc_id"] is not None, d["doc_id"] or 0, leaf(d), d))
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: levels([x[2] for x in sorted(by[g], key=lambda x: x[:3])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, _, own, d) in enumerate(sorted(by[g], key=lambda x: x[:3])):
            sib = siblings(trees[g], i) + siblings(top, k)
            claim = own
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0 and d["n_chars"] is not None:
                claim = leaf(d, n_chars=d["n_chars"] + 1)
            got = fold(claim, sib)
            out.append((d["doc_id"], own, trees[g][-1][0], top[-1][0], h(*(s for s, _ in sib if s)), got, got == top[-1][0]))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def check(df, **how):
    docs = [r.asDict() for r in df.collect()]
    got = merkle.verified_rows(df, **how)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(rows(got), key=key) == sorted(brute(docs), key=key)


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(spark):
    check(odd_docs(spark))
    assert rows(merkle.verified_rows(no_docs(spark))) == []


def test_several_tiers_and_many_languages(spark):
    rng = random.Random(3)
    langs = [None, "", "é", "z", "Z", "𝄞"] + [f"l{i}" for i in range(30)]
    docs = [(i, f"text {i}", rng.choice(langs) if i % 3 else "en", None, i if i % 5 else None) for i in range(700)]
    docs += [(5, "again", "en", "s", 1)] * 40 + [(None, "x", "en", "s", 2)] * 3
    check(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), levels=2)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 127, 130, 1000])
def test_positions_are_those_of_completion(n):
    """A builder's log, and closed-form positions, against a plain walk of the tree."""
    order = []

    def walk(level, index):
        for child in (2 * index, 2 * index + 1):
            if level and (child << (level - 1)) < n:
                walk(level - 1, child)
        order.append((level, index))
    walk(merkle.height(n), 0)
    assert [merkle.position(lv, i, n) for lv, i in order] == list(range(len(order)))
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    log = merkle.grow(leaves, merkle.height(n))
    lv = levels([x.hex() for x in leaves])
    assert [x.hex() for x in log] == [lv[a][b] for a, b in order]


def test_log_is_the_postorder_of_each_tree(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    trees, _ = merkle.manifest(d)
    got = defaultdict(dict)
    for r in merkle.log_nodes(trees).collect():
        got[r.tree][r.position] = (r.level, r.node)
    by = defaultdict(list)
    for r in d.orderBy("doc_id").collect():
        by["x" + r.lang].append(leaf(r.asDict()))
    assert set(got) == set(by)
    for tree, nodes in got.items():
        assert sorted(nodes) == list(range(merkle.subtree_size(len(by[tree]), merkle.height(len(by[tree])))))
        lv, count = levels(by[tree]), defaultdict(int)
        for p in sorted(nodes):
            level, node = nodes[p]
            assert node == lv[level][count[level]]
            count[level] += 1


def test_a_changed_field_is_found(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for r in merkle.verified_rows(d).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
