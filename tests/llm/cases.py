"""Rows that every operator must survive: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}{'abcdef'[rng.randrange(6)]}" for _ in range(n))


def odd_docs(spark):
    long = prose(99, 60_000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, prose(4, 80), "en", None, 1),
            (4, prose(4, 80), "en", None, 1), (None, prose(5, 80), "en", "b", 1), (None, None, None, "b", None),
            (6, long, "en", "b", 1), (7, prose(4, 80), "de", "c", 1), (8, "one", "en", "c", 1), (9, "one", "en", "c", 1),
            (4, prose(44, 80), "en", "c", 1)]
    # names that operators use inside
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in (
        "key", "row", "text_key", "n", "h", "size", "source_size", "pid", "words", "label", "order", "found", "new", "tokens", "item_id")})


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]
