import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from meterstar.llm import content_sort
from tests.llm.cases import no_docs, odd_docs, rows

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    top = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    return [(d, top[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in docs]


def key(r):
    return tuple((x is not None, x) for x in r)


def check(df, docs):
    assert df.columns == COLUMNS
    got = rows(df)
    assert sorted((r[:3] + r[4:] for r in got), key=key) == sorted(brute(docs), key=key)
    kept = [r for r in got if r[3]]
    assert all(r[0] == r[1] for r in kept) and len(kept) == len({t or "" for _, t in docs})


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    check(content_sort.equal_texts(d), [(r.doc_id, r.text) for r in d.collect()])


def test_odd_rows(spark):
    d = odd_docs(spark)
    check(content_sort.equal_texts(d), [(r.doc_id, r.text) for r in d.collect()])
    assert rows(content_sort.equal_texts(no_docs(spark))) == []


def test_only_whole_texts_are_equal(spark):
    head = "x" * 5000
    docs = [(i, t) for i, t in enumerate([head, head + " ", head + "a", head + "A", head, "é", "é", " ", "", None, "\n"])]
    check(content_sort.equal_texts(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_groups_split_over_runs(spark, monkeypatch):
    monkeypatch.setattr(content_sort, "SHARE", 8)
    docs = [(i, "hot") for i in range(900)] + [(7, "hot")] * 300 + [(None, "hot")] * 5 + [(i, f"own {i}") for i in range(400)]
    docs += [(i, "warm") for i in range(1000, 1330)] + [(None, "no id")] * 400
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(13)
    check(content_sort.equal_texts(d), docs)


def test_texts_move_once_and_nothing_runs_in_python(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    keep = content_sort.staged
    content_sort.staged = lambda df, name: (seen.append(df._jdf.queryExecution().toString()), keep(df, name))[1]
    try:
        content_sort.equal_texts(d)
    finally:
        content_sort.staged = keep
    plan = seen[0].split("== Physical Plan ==")[1]
    assert plan.count("Exchange rangepartitioning") == 1 and "Python" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # counts of hashes, not texts


def test_other_columns_do_not_clash(spark):
    d = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    d = d.withColumns({c: F.lit(1) for c in ("head", "h", "run", "n", "runs", "keep_id", "place", "split", "sha")})
    assert sorted(rows(content_sort.equal_texts(d)))[0][:4] == (1, 2, 2, False)
