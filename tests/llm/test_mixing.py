import pytest

from meterstar.llm.mixing import mix
from tests.llm.cases import no_docs, odd_docs, prose


def targets(sizes):
    """Water filling, step by step, over (source, size) in code point order."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, rest, free = {}, 1.5 * sum(sizes.values()), list(order)
    while free:
        unit = rest / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * unit > 2 * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in free}
        for s in full:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
            free.remove(s)
    return out


def by_source(rows):
    out = {}
    for r in rows:
        x = out.setdefault(r["source"], [0, 0, r["mix_target"], r["mix_source_size"]])
        x[0] += r["mix_taken"]
        x[1] += r["mix_size"]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken_words(spark, seed):
    import random
    rng = random.Random(seed)
    names = [None, "a", "B", "é", "z", "hot", "tiny"]
    docs = [(i, prose(i, rng.choice([1, 5, 40, 300])), rng.choice(names[:-1] + ["hot"] * 5)) for i in range(300)] + [(999, "w", "tiny")]
    got = mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), keep=True).collect()
    assert len(got) == len(docs)
    sums = by_source(got)
    want = targets({s: v[1] for s, v in sums.items()})
    for s, (taken, size, target, source_size) in sums.items():
        assert source_size == size and target == pytest.approx(want[s]) and abs(taken - target) <= 1
    assert all(0 <= r["mix_taken"] <= 2 * r["mix_size"] == 2 * len(r["text"].split()) for r in got)


def test_reruns_and_other_partitions_agree(spark):
    docs = spark.createDataFrame([(i, prose(i, i % 50), f"s{i % 4}") for i in range(200)], "doc_id long, text string, source string")
    assert sorted(mix(docs).collect()) == sorted(mix(docs.repartition(7)).collect())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    plain, kept = mix(docs).collect(), mix(docs, keep=True).collect()
    assert len(plain) == len(kept) == docs.count() and all(r["taken"] <= 2 * r["size"] for r in plain)
    assert set(docs.columns) < set(kept[0].asDict()) and {r["size"] for r in kept} == {1}
    assert all(abs(v[0] - v[2]) <= 2 for v in by_source(kept).values())
    assert mix(no_docs(spark)).count() == 0


def test_only_texts_without_words(spark):
    got = mix(spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in got] == [(0, 0, 0.0)] * 2
