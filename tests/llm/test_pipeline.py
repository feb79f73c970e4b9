import hashlib

import corpus_pipeline as C
from meterstar.llm import decontam, pii, quality
from tests.llm.cases import DOCS, prose
from tests.llm.test_mixing import targets
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "mixing"]
    seen = docs
    for name, stage in C.STAGES:
        out = stage(spark, seen, SF)
        if name != "mixing":
            assert out.columns == docs.columns
        before, after = {r["doc_id"]: r for r in seen.collect()}, {r["doc_id"]: r for r in out.collect()}
        if name == "quality":
            want = quality.scored(seen, quality.train(seen, labels, "quality")).where("predicted = 1")
            assert set(after) == {r["doc_id"] for r in want.collect()} and 0.7 * len(before) < len(after) < len(before)
        elif name == "near_duplicates":
            comp = brute([(d, r["text"]) for d, r in before.items()])
            assert set(after) == {c for _, _, c in comp}
        elif name == "decontamination":
            bad = {r["doc_id"] for r in decontam.overlaps(seen, bench).collect()}
            assert set(after) == set(before) - bad
        elif name == "pii":
            assert set(after) == set(before)
            assert {d: r["text"] for d, r in after.items()} == {r["doc_id"]: r["text"] for r in pii.pseudonymise(seen).collect()}
            assert any(r["text"] != before[d]["text"] for d, r in after.items())
        else:
            want = brute_mix([(d, r["text"], r["source"]) for d, r in before.items()])
            assert {d: r["mix_taken"] for d, r in after.items()} == want and 0 < len(want) < len(before)
        seen = spark.createDataFrame(out.collect(), out.schema)
    whole = C.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, seen.collect()))


def test_each_stage_takes_empty_documents(spark):
    none = spark.createDataFrame([], DOCS)
    for _, stage in C.STAGES:
        assert stage(spark, none, SF).count() == 0


def brute_mix(docs):
    """Words that the mix takes of each document (those of which it takes some), by a walk in the order of their hash."""
    words = {d: len((text or "").split()) for d, text, _ in docs}
    of = {}
    for d, _, source in docs:
        of.setdefault(source, []).append(d)
    out = {}
    for source, target in targets({s: sum(words[d] for d in ids) for s, ids in of.items()}).items():
        rest = round(target)
        for _ in range(2):
            for d in sorted(of[source], key=lambda d: (hashlib.md5(str(d).encode()).hexdigest()[:15], d)):
                out[d] = out.get(d, 0) + min(words[d], rest)
                rest -= min(words[d], rest)
    return {d: n for d, n in out.items() if n}


def test_mixing_leaves_out_what_the_mix_does_not_take(spark):
    docs = [(i, prose(i, i % 40), None, "abc"[i % 3], 1) for i in range(300)]
    got = {r["doc_id"]: r["mix_taken"] for r in C.mixing_stage(spark, spark.createDataFrame(docs, DOCS), SF).collect()}
    assert got == brute_mix([(d[0], d[1], d[3]) for d in docs])
    assert any(d[0] not in got and d[1] for d in docs)
