import numpy as np
import pytest

from meterstar.llm import quality, toxicity
from meterstar.llm.common import text_fold
from tests.llm.cases import no_docs, odd_docs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))


def held_out(scored, labels, column):
    return scored.where("held_out").join(labels, "doc_id").select("score", "predicted", column).toPandas()


def test_quality_of_held_out_documents(tables):
    docs, labels = tables
    got = held_out(quality.scored(docs, quality.train(docs, labels, "quality")), labels, "quality")
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert got.loc[got["quality"] == 1, "predicted"].mean() > 0.98


def test_toxicity_of_held_out_documents(tables):
    docs, labels = tables
    got = held_out(toxicity.scored(docs, toxicity.train(docs, labels, "toxic")), labels, "toxic")
    pos, neg = (got.loc[got["toxic"] == y, "score"].to_numpy() for y in (1, 0))
    assert (pos[:, None] > neg[None, :]).mean() > 0.8
    assert got.loc[got["toxic"] == 0, "predicted"].mean() < 0.1


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_labels_of_the_held_out_fold_teach_nothing(spark, tables, module, column):
    docs, labels = tables
    parts, hold = (3, 1) if module is quality else (4, 2)
    other = labels.withColumn(column, (text_fold("doc_id", parts) == hold).cast("int") * (1 - labels[column]) + (text_fold("doc_id", parts) != hold).cast("int") * labels[column])
    one, two = (module.scored(docs, module.train(docs, x, column)).orderBy("doc_id").toPandas() for x in (labels, other))
    assert np.allclose(one["score"], two["score"])


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, column):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (8, 1, 0), (9, None, None), (8, 1, 0), (7, 0, 1), (7, 1, 0), (None, 1, 1), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.where(f"{column} = 1")):
        got = module.scored(docs, module.train(docs, some, column))
        assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
        rows = got.collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    model = module.train(docs, labels, column)
    assert module.scored(no_docs(spark), model).count() == 0
    assert module.train(no_docs(spark), labels, column) is not None


def test_accepted_rows_keep_their_columns(spark, tables):
    docs, labels = tables
    model = quality.train(docs, labels, "quality")
    kept = quality.accepted(odd_docs(spark), model)
    assert kept.schema == odd_docs(spark).schema
    want = quality.scored(docs, model).where("predicted = 1").count()
    assert quality.accepted(docs, model).count() == want


def test_shared_backoff_leaves_unknown_words_neutral():
    words = [b"idiot", b"table", b"chair", b"idle"]
    r = toxicity.kneser_ney(words, np.array([50, 2, 2, 1]), np.array([0, 60, 50, 9]))
    assert r.of(b"idiot") > 1 and r.of(b"table") < 0 and abs(r.of(b"zzz")) < abs(r.of(b"idiot"))


def test_every_byte_of_long_runs_is_read():
    bad, good = "\u6076\u4eba\u6eda", "\u4eca\u65e5\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed"
    assert any(x.startswith(bad.encode()) for x in toxicity.expressions(good + bad))
    for mark in ("\u00a0", "\u2014", "\u3000", "\u00ab"):
        assert toxicity.expressions(f"perfectly{mark}Idiot") == [b"perfectly", b"idiot"]
    word = "\u043f\u0440\u0435\u0432\u043e\u0441\u0445\u043e\u0434\u0438\u0442\u0435\u043b\u044c\u043d\u043e"
    for w in (word, "a" * 13 + "\u00e9bcdefgh", "abcdefghijklmnopqrstuvwxyz"):
        got = toxicity.expressions(w)
        assert all(len(x) <= toxicity.DEPTH and x.decode() for x in got) and got[-1].decode()[-1] == w[-1]
        assert b"".join([got[0], *[x.decode()[-1].encode() for x in got[1:]]]).decode()[-1] == w[-1] and {*w} == {c for x in got for c in x.decode()}
    texts = [good] * 9 + [good + bad] * 9
    words = sorted({x for t in texts for x in toxicity.expressions(t)})
    n = [np.array([sum(toxicity.expressions(t).count(w) for t in part) for w in words]) for part in (texts[9:], texts[:9])]
    known = toxicity.kneser_ney(words, *n)
    assert toxicity.evidence(good + bad, known, {})[0] > toxicity.evidence(good, known, {})[0]
