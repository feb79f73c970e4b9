import random
import re
from collections import Counter

import pytest

from meterstar.llm.common import components
from meterstar.llm.ngram_join import ngram_components, one_per_component
from tests.llm.cases import DOCS, no_docs, odd_docs, prose


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    """(id, set size, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return Counter((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(docs))


def varied(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_equals_brute_force_on_near_copies_and_shared_passages(spark):
    rng = random.Random(3)
    passage = prose(1000, 60)
    docs = []
    for g in range(12):
        base = prose(g, rng.choice([4, 5, 6, 9, 20, 60, 150]))
        for _ in range(rng.choice([1, 2, 9])):
            docs.append(varied(rng, base, rng.choice([0, 0, 1, 2, 4])))
    docs += [f"{passage} {prose(2000 + i, n)}" for i, n in enumerate([2, 3, 5, 8, 10, 12, 15, 40, 300])]
    docs += [f"{prose(3000 + i, n)} {passage}" for i, n in enumerate([2, 6, 10, 14])]
    rng.shuffle(docs)
    rows = list(enumerate(docs, 100))
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = ngram_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(tuple(r) for r in got.collect()) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ngram_components(no_docs(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    docs = odd_docs(spark)
    kept = one_per_component(docs)
    assert kept.columns == docs.columns
    # texts without words stay, the copies of document 4 and of "one" go
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, len(r["text"] or "")) for r in kept.collect()))
    want = sorted([(False, 1, 0), (False, 2, 0), (False, 3, 4), (True, 0, 0), (False, 8, 3)]
                  + [(r["doc_id"] is None, r["doc_id"] or 0, len(r["text"])) for r in docs.dropDuplicates(["doc_id", "text"]).collect()
                     if r["text"] and len(r["text"]) > 10 and r["doc_id"] != 7])
    assert got == want


@pytest.mark.parametrize("case", ["A b C d", "a b c d e"])
def test_case_and_blanks_do_not_matter(spark, case):
    docs = spark.createDataFrame([(1, case), (2, case.upper().replace(" ", "\t\n"))], "doc_id long, text string")
    assert {r["component_id"] for r in ngram_components(docs).collect()} == {1}


def test_schema_of_docs(spark):
    assert DOCS.startswith("doc_id long")
