import itertools
import random

from meterstar.llm import decontam
from tests.llm.cases import no_docs, odd_docs, prose

ITEMS = "item_id long, text string"


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), ITEMS)


def changed(text, every, start=3):
    w = text.split()
    for i in range(start, len(w), every):
        w[i] = f"sub{i}"
    return " ".join(w)


def test_finds_exact_and_substituted_items_and_leaves_clean_texts(spark):
    rng = random.Random(1)
    items = [prose(500 + i, rng.randint(12, 60), 5000) for i in range(25)]
    docs, want = [], set()
    for i in range(120):
        body = prose(i, 150, 5000)
        if i % 4 == 0:
            item = items[i // 4 % 25]
            text = [item, item.upper().replace(" ", ",\n"), changed(item, 7)][i // 4 % 3]
            body = f"{prose(i, 40, 5000)} {text} {prose(-i, 40, 5000)}"
            want.add((i, i // 4 % 25))
        docs.append((i, body))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontam.overlaps(df, bench(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["similarity"] >= 0.8 and r["doc_start"] == 40 for r in got)
    kept = decontam.decontaminated(df, bench(spark, items))
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(120) if i % 4]


def test_excerpt_of_a_long_item_counts_and_a_few_common_words_do_not(spark):
    item = prose(7, 200, 5000)
    w = item.split()
    docs = [(1, prose(1, 50, 5000) + " " + " ".join(w[60:90])), (2, prose(2, 50, 5000) + " " + " ".join(w[60:69]) + " " + prose(3, 50, 5000))]
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, [item])).collect()
    assert [(r["doc_id"], r["item_start"] <= 60) for r in got] == [(1, True)]


def test_blocks_give_the_same_rows(spark, monkeypatch):
    items = [prose(900 + i, 30, 5000) for i in range(12)]
    df = spark.createDataFrame([(i, prose(i, 30, 5000) + " " + items[i % 12]) for i in range(30)], "doc_id long, text string")
    one = sorted(decontam.overlaps(df, bench(spark, items)).collect())
    monkeypatch.setattr(decontam, "BLOCK_SEEDS", 200)
    assert sorted(decontam.overlaps(df, bench(spark, items)).collect()) == one and len(one) == 30


def test_odd_rows(spark):
    docs = odd_docs(spark)
    items = bench(spark, [None, "", "one", prose(4, 80)])
    got = decontam.overlaps(docs, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(4, 3), (7, 3)]
    kept = decontam.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert decontam.overlaps(no_docs(spark), items).count() == 0
    assert decontam.decontaminated(docs, items.limit(0)).count() == docs.count()


def test_short_items_and_scripts_without_blanks(spark):
    cjk = "\u6c34\u306e\u5316\u5b66\u5f0f\u306f\u4f55\u3067\u3059\u304b\u7b54\u3048\u306f\u5206\u5b50"
    thai = "\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e2b\u0e25\u0e27\u0e07"
    items = ["Who wrote Hamlet?", prose(1, 8), cjk, thai, "lone"]
    docs = [(0, prose(2, 31) + ": who wrote\nHAMLET " + prose(3, 30)), (1, prose(4, 30) + " " + items[1]), (2, f"abc{cjk[:3]}X{cjk[4:]}def"),
            (3, f"{thai[::-1]} {thai}"), (4, "who wrote macbeth and hamlet lone " + " ".join(prose(1, 8).split()[:7])), (5, cjk[:8] + thai[:3])]
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(0, 0), (1, 1), (2, 2), (3, 3)]


def test_masks_meet_every_accepted_alignment():
    for m in range(decontam.SPAN, 21):
        places = [{at + o for o in mask} for mask in decontam.MASKS for at in range(m - mask[-1])]
        for lost in itertools.combinations(range(m), m // 5):
            assert any(p.isdisjoint(lost) for p in places), (m, lost)


def test_substituted_short_items_are_found_at_odd_and_even_places(spark):
    rng = random.Random(3)
    items = [prose(3000 + m, m, 5000) for m in (9, 10, 12, 15)]
    docs = []
    for i in range(160):
        w = items[i % 4].split()
        for j in rng.sample(range(len(w)), len(w) // 5):
            w[j] = f"sub{j}"
        docs.append((i, " ".join([prose(i, 30 + i // 4 % 2, 5000), *w, prose(-i, 30, 5000)])))
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i % 4) for i in range(160)}
