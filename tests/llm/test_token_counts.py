import random

import pytest

from meterstar.llm import token_counts as T
from tests.llm.cases import no_docs, odd_docs

SIGNS = ["a", "B", " ", "  ", "\n", "'s", "!!", "é", "7", "12345678", "the", " it", "'", "\t", " \n", "%%%", " "]


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.read_ranks())


def changed(text, edits):
    out, at = [], 0
    for start, end, new in edits:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:]


def random_edits(rng, text):
    places = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(1, 4))))
    spans = [(a, b if rng.random() < 0.7 else a) for a, b in zip(places[::2], places[1::2])]
    return [(a, b, "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 3)))) for a, b in spans]


@pytest.mark.parametrize("seed", range(4))
def test_edits_equal_encoding_again_as_a_whole(counter, seed):
    rng = random.Random(seed)
    whole = counter.encoding.encode_ordinary
    for _ in range(1500):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 50)))
        tree = T.CountTree(text, counter)
        assert tree.total == len(whole(text))
        edits = random_edits(rng, text)
        tree.apply(edits)
        assert tree.edited() == changed(text, edits)
        assert tree.total == len(whole(tree.edited())) == tree.sums[tree.size:].sum()


def test_one_edit_touches_few_pretokens(counter):
    text = " ".join(f"word{i}" for i in range(5000))
    tree = T.CountTree(text, counter)
    tree.apply([(20_000, 20_003, "xyz")])
    assert tree.encoded < 12 and tree.total == len(counter.encoding.encode_ordinary(tree.edited()))


def test_query_over_a_table(spark, counter):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in T.counted(docs).collect()}
    for d in docs.collect():
        r, edits = got[d["doc_id"]], T.cleaning_edits(d["text"])
        assert r["n_tokens"] == len(counter.encoding.encode_ordinary(d["text"]))
        assert r["n_edits"] == len(edits)
        assert r["n_tokens_edited"] == len(counter.encoding.encode_ordinary(changed(d["text"], edits)))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = T.counted(docs).collect()
    assert len(got) == docs.count()
    assert {(r["n_tokens"], r["n_edits"], r["n_tokens_edited"]) for r in got if r["doc_id"] in (1, 2)} == {(0, 0, 0)}
    assert T.counted(no_docs(spark)).count() == 0


@pytest.mark.parametrize("run", [" ", "x", "́", "!", "7", "\n"])
def test_long_runs_count_as_shorter_ones_do(counter, run):
    whole = counter.encoding.encode_ordinary
    for n in (T.LONG - 1, T.LONG, T.LONG + 1, 20_000):
        assert T.CountTree(run * n, counter).total == len(whole(run * n))


def test_runs_of_two_million_characters(spark):
    n = 2_000_000
    docs = spark.createDataFrame([(1, " " * n), (2, "x" * n), (3, "́" * n), (4, "a " + "!" * n), (5, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in T.counted(docs).collect()}
    assert got[5].n_tokens == 2 and got[4].n_tokens_edited == 2 and got[4].n_edits == 1   # "a", " !"
    assert all(0 < got[i].n_tokens for i in (1, 2, 3))
