import numpy as np
import pytest

from meterstar.llm import ann

SF = "/root/testdata/sf0.01"


def test_hilbert_neighbours_are_one_step_apart():
    side, dims = 8, 3
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = ann.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(side ** dims))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(ids, x, k, every=20):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        best = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[i])[:k]
        out[ids[i]] = [j for _, j in best]
    return out


def recall(got, want):
    return sum(len({r["vec_id"] for r in got if r["query_id"] == q} & set(w)) for q, w in want.items()) / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("kind", ["table", "clusters", "lengths"])
def test_recall_order_and_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "SPAN", 256)
    rng = np.random.default_rng(1)
    if kind == "table":
        pdf = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").toPandas()
        ids, x = pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"]).astype(float)
    else:
        ids, x = np.arange(1500), rng.normal(size=(60, 16))[rng.integers(0, 60, 1500)] + 0.1 * rng.normal(size=(1500, 16))
        if kind == "lengths":
            x *= rng.uniform(0.2, 3, (1500, 1))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = ann.nearest(df).collect()
    want = brute(ids, x, 20)
    assert recall(got, want) >= 0.9
    at = {i: n for n, i in enumerate(ids)}
    for q in want:
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        assert all(np.isclose(r["score"], x[at[q]] @ x[at[r["vec_id"]]]) for r in mine)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 0.0]), (6, [1.0, 2.0, 3.0]),
            (7, [2.0, 1.0]), (8, [2.0, -1.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]), (None, [1.0, 1.0]), (20, [0.0, 0.0]), (40, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, curve int, rank string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df).collect())
    assert got == [(0, 1, 7, 2.0), (0, 2, 8, 2.0), (0, 3, 40, 0.0), (0, 4, 9, -1.0),
                   (40, 1, 7, 1.0), (40, 2, 0, 0.0), (40, 3, 9, 0.0), (40, 4, 8, -1.0)]
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id in (7, 8)")).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0


def test_many_equal_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0] if i < 700 else [float(i % 7), 1.0]) for i in range(1000)], "vec_id long, embedding array<double>")
    got = ann.nearest(df)
    assert got.count() == 50 * 20


def test_equal_vectors_tie_exactly(spark):
    """Rows with the same vector have the same score to the last bit wherever they lie in a block, so ids decide
    (among those that the window found)."""
    rng = np.random.default_rng(4)
    one, two = rng.normal(size=41), rng.normal(size=41)
    df = spark.createDataFrame([(i, (one if i % 3 else two).tolist()) for i in range(1000)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert len(got) == 50
    for q, found in got.items():
        ids = [v for _, v, _ in sorted(found)]
        assert ids == sorted(ids) and len(ids) == 20 and all((i % 3 == 0) == (q % 3 == 0) for i in ids)
        assert len({s for _, _, s in found}) == 1


def test_many_queries_on_one_place_of_a_curve(spark, monkeypatch):
    """One very long vector puts all other queries on few places; chunks stay bounded and nothing is lost."""
    monkeypatch.setattr(ann, "QUERIES", 16)
    monkeypatch.setattr(ann, "SPAN", 128)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 8))
    x[1] *= 1e6
    ids = np.arange(1200)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = ann.nearest(df).collect()
    assert len(got) == 60 * 20 and recall(got, brute(ids, x, 20)) >= 0.9
