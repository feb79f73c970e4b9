import random

import numpy as np

from meterstar.llm import paragraph_dedup as P
from tests.llm.cases import no_docs, odd_docs, prose


def passages(spark, docs):
    return P.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()


def test_bands_reach_the_recall():
    assert P.BANDS == 5 and 1 - (1 - 0.8 ** P.ROWS) ** P.BANDS >= P.RECALL


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(2)
    planted = [prose(5000 + i, rng.randint(55, 120), 50_000) for i in range(8)]
    docs, with_passage = [], {}
    for i in range(160):
        before, after = prose(10_000 + i, rng.randint(0, 90), 50_000), prose(20_000 + i, rng.randint(0, 90), 50_000)
        if i % 5 == 0:
            with_passage[i] = i // 5 % 8
            middle = planted[i // 5 % 8].replace(" ", rng.choice([" ", "\n", "  "]), 1)
            docs.append((i, rng.choice([" ", "\n"]).join(x for x in (before, middle, after) if x)))
        else:
            docs.append((i, f"{before}\nAll rights reserved by them.\n{after}"))
    got = passages(spark, docs)
    assert {r["doc_id"] for r in got} == set(with_passage)
    for i, p in with_passage.items():
        first = min(j for j, q in with_passage.items() if q == p)
        mine = [r for r in got if r["doc_id"] == i]
        assert first in {d for r in mine for d in r["kept_doc_ids"]}
        assert (sum(r["removed_words"] for r in mine) > 0) == (i != first)
        assert sum(r["n_words"] for r in mine) >= 0.5 * len(planted[p].split())


def test_near_copies_of_paragraphs_meet_by_minhash(spark):
    lines = [prose(700 + i, 60, 50_000) for i in range(30)]
    old = P.MOST_WORDS
    docs = [(i, t) for i, t in enumerate(lines)] + [(100 + i, t + " more") for i, t in enumerate(lines)]
    got = passages(spark, docs)
    assert old == P.MOST_WORDS and {r["doc_id"] for r in got} == {d for d, _ in docs}
    for i in range(30):
        assert any(r["doc_id"] == 100 + i and r["removed_words"] and i in r["kept_doc_ids"] for r in got)


def test_cuts_depend_on_nearby_words_only():
    mid = prose(1, 300, 50_000)
    _, a = P.split_paragraphs(mid)
    _, b = P.split_paragraphs(prose(2, 77, 50_000) + " " + mid + " " + prose(3, 50, 50_000))
    inner = {x for x in a.tolist() if 10 < x < 290}
    assert len(inner) > 10 and inner <= {x - 77 for x in b.tolist()}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = P.repeated_passages(docs)
    assert got.columns == ["doc_id", "begin_word", "n_words", "n_paragraphs", "removed_words", "kept_doc_ids"]
    rows = got.collect()
    # document 7 repeats document 4; the repeated rows of document 4 count once
    assert {r["doc_id"] for r in rows} == {4, 7} and len({(r["doc_id"], r["begin_word"]) for r in rows}) == len(rows)
    assert P.repeated_passages(no_docs(spark)).count() == 0


def one_piece(seeds, n, before=""):
    """The first text of ``n`` words after ``before`` that holds no cut."""
    return next(t for t in (f"{before}{prose(s, n, 50_000)}" for s in seeds) if len(P.split_paragraphs(t + " x0")[1]) == 1)


def test_near_copies_meet_beside_an_unrelated_hub(spark):
    """Every paragraph begins with the same 14 words, so common shingles name most bands and hubs."""
    head, docs = one_piece(range(100), 14) + " ", []
    for i in range(60):
        own = one_piece(range(1000 + 500 * i, 1500 + 500 * i), 5, head)
        docs += [(2 * i + j, f"{own} {'xy'[j]}0") for j in (0, 1)]  # two near copies: the last word differs
    docs = [d for d in docs if len(P.split_paragraphs(d[1])[1]) == 1]
    both = [i for i in range(60) if {2 * i, 2 * i + 1} <= {d for d, _ in docs}]
    got = {(r["doc_id"], *r["kept_doc_ids"]) for r in passages(spark, docs) if r["removed_words"]}
    assert len(both) > 40 and got == {(2 * i + 1, 2 * i) for i in both}


def test_paragraphs_with_a_replaced_word_by_brute_force(spark):
    """All pairs of lines of 50 and 60 words, compared one by one: near ones are reported whole, others not at all."""
    rng, docs = random.Random(5), []
    for i in range(240):
        words = prose(40_000 + i, 50 + 10 * (i % 2), 50_000).split()
        docs.append((2 * i, " ".join(words)))
        for at in rng.sample(range(len(words)), 1 + i % 5 // 4):  # every fifth has two words replaced
            words[at] = f"new{i}x{at}"
        docs.append((2 * i + 1, f"{prose(60_000 + i, 30, 50_000)}\n{' '.join(words)}\n{prose(70_000 + i, 30, 50_000)}"))

    def shingles(line):
        w = line.split()
        return {tuple(w[i: i + 5]) for i in range(len(w) - 4)}

    sets = [(d, shingles(line)) for d, text in docs for line in text.split("\n")]
    by = {}
    for n, (_, x) in enumerate(sets):
        for y in x:
            by.setdefault(y, []).append(n)
    near = {tuple(sorted((sets[a][0], sets[b][0]))) for ns in by.values() for a in ns for b in ns
            if a < b and 100 * len(sets[a][1] & sets[b][1]) >= 80 * len(sets[a][1] | sets[b][1])}
    assert len(near) > 150
    got = {}
    for r in passages(spark, docs):
        got.setdefault(r["doc_id"], []).append(r)
    whole = [(a, b) for a, b in near if any(r["removed_words"] >= 50 and r["begin_word"] == 30 and a in r["kept_doc_ids"] for r in got.get(b, []))]
    assert len(whole) >= 0.95 * len(near)
    words = sum(r["n_words"] for a, b in near for r in got.get(b, []))
    assert words >= 0.95 * sum(50 + 10 * (a // 2 % 2) for a, b in near)
    # what is not near is reported where its pieces are equal, never beyond the planted line
    assert all(30 <= r["begin_word"] and r["begin_word"] + r["n_words"] <= 90 for d in got if d % 2 for r in got[d])


def test_natural_paragraphs_are_lines_and_blocks_between_blank_lines():
    def places(text):
        h, sizes = P._lines(text)
        begin, end = P.natural_paragraphs(sizes)
        return h, sorted(zip(begin.tolist(), end.tolist()))

    a, b, c = (prose(i, 20, 50_000) for i in range(3))
    assert places(f"{a}\n{b}\n{c}")[1] == [(0, 20), (20, 40), (40, 60)]
    assert places(f"{a}\n{b}\n\n{c}\n")[1] == [(0, 20), (0, 40), (20, 40), (40, 60)]
    assert places(f"\n\nx y\n{b}\nz\n\n{c}")[1] == [(0, 23), (2, 22), (23, 43)]
    assert places("")[1] == places("\n\n")[1] == places("a b c")[1] == []
    # equal words, equal keys and bands, wherever they stand and however they are wrapped
    wrapped = f"{c}\n\n{a}\n{b}\n\n{c}"
    h, at = places(wrapped)
    key, band = P.paragraph_keys(h, *(np.array(x) for x in zip(*at)))
    one, two = (P.paragraph_keys(x, *(np.array(y) for y in ([0], [len(x)]))) for x in (places(f"{a} {b}")[0], places(c)[0]))
    k = {p: (key[i], band[i].tolist()) for i, p in enumerate(at)}
    assert k[20, 60] == (one[0][0], one[1][0].tolist()) and k[0, 20] == k[60, 80] == (two[0][0], two[1][0].tolist())
    assert len({x for x, _ in k.values()}) == 4


def test_overlapping_repeats_count_each_word_once(spark):
    a, b = prose(91, 40, 50_000), prose(92, 40, 50_000)
    got = {r["doc_id"]: r for r in passages(spark, [(1, f"{a}\n{b}"), (2, f"{prose(93, 25, 50_000)}\n\n{a}\n{b}\n\nend"), (3, b)])}
    assert {d: (r["begin_word"], r["n_words"], r["removed_words"]) for d, r in got.items()} == {1: (0, 80, 0), 2: (25, 80, 80), 3: (0, 40, 40)}
    assert all(r["kept_doc_ids"] == [1] for r in got.values())


def test_few_words_beside_long_lines_stay_with_their_neighbours():
    for i in range(200):
        h, at = P.split_paragraphs(f"{prose(i, 24, 50_000)}\n{prose(300 + i, 70, 50_000)}\n{prose(600 + i, 20, 50_000)}")
        sizes = [b - a for a, b in zip(at, [*at[1:], len(h)])]
        assert {24, 94} <= set(at.tolist()) and min(sizes) >= P.LEAST_WORDS


def test_documents_are_cut_alike_alone_and_in_blocks():
    texts = [prose(i, 7 * i % 150, 50_000).replace(" ", "\n", i % 4) for i in range(60)] + ["", "same " * 90, f"{prose(1, 25)}\n\nab"]
    lines = [P._lines(t) for t in texts]
    sizes = np.array([len(h) for h, _ in lines])
    ends = np.cumsum(sizes)
    got = P._pieces(np.concatenate([h for h, _ in lines]), np.concatenate([s for _, s in lines]), ends)
    want = [P.split_paragraphs(t)[1] + e - n for t, e, n in zip(texts, ends, sizes)]
    assert got.tolist() == np.concatenate(want).tolist()
