"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import staged

# Token offsets that a seed reads; the positions between them may hold any token. Whichever fifth of SPAN or more
# tokens is replaced (see LEAST_EQUAL), one mask at one place reads none of it.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 5, 6, 7), (0, 1, 3, 5, 7, 8), (0, 1, 3, 4, 5, 6), (0, 1, 3, 4, 6, 7))
SPAN = 9               # tokens from the first to the last offset of the longest mask
LEAST_TOKENS = 2       # tokens of the shortest item: a single word is no text
WINDOW = 20            # tokens of an excerpt that counts as an overlap by itself
LEAST_EQUAL = 0.8      # share of equal tokens in the item, or in one window of it
BLOCK_SEEDS = 500_000  # seeds of the benchmark that one pass over the documents broadcasts (16 bytes each)
# Letters of scripts that set no blanks between words; the lookahead spares others the search for their script.
NO_SPACE = r"(?=[\x{0E00}-\x{1FFF}\x{2E80}-\x{3FFFF}])[" + "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan", "Javanese",
                                                  "Balinese", "Tai_Le", "New_Tai_Lue", "Tai_Tham", "Tai_Viet")) + "]"


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, so that marks around words do not matter.

    Scripts that set no blanks between words give one token a character.
    """
    text = F.coalesce(text, F.lit(""))
    parted = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.regexp_replace(F.lower(text), NO_SPACE, " $0 "))
    words = F.filter(F.split(parted, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, tokens: str, exact: list[int]) -> DataFrame:
    """``rows`` once per seed, with ``seed`` and its place ``at``: every mask at every token, and for each length in
    ``exact`` every run of so many tokens."""
    placed = rows.where(F.size(tokens) > 0).select("*", F.explode(F.sequence(F.lit(0), F.size(tokens) - 1)).alias("at"))
    def of(mask: tuple[int, ...], no: int) -> Column:
        return F.when(F.col("at") + mask[-1] < F.size(tokens), F.xxhash64(F.lit(no), *[F.get(tokens, F.col("at") + o) for o in mask]))
    seeds = [of(m, no) for no, m in enumerate(MASKS)] + [of(tuple(range(n)), -n) for n in exact]
    return placed.select(*[c for c in rows.columns if c != tokens], "at", F.explode(F.array(*seeds)).alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Benchmark items found in documents: one row per (document row, item) with its best alignment.

    Fixed masks read some offsets of a token run and ignore the others, so a replaced token breaks
    only the seeds that read it. Document seeds meet item seeds in a hash join; a hit fixes an
    alignment (document position minus item position), which is then verified token by token: an
    item overlaps when LEAST_EQUAL of all its tokens are equal, or LEAST_EQUAL of some WINDOW
    consecutive ones. The masks miss no such alignment (tests/llm try all replacements). Items under SPAN tokens
    have a path of their own: the hash of the whole item meets those of all document runs of the same
    length, and all tokens must be equal.

    Item seeds are broadcast in blocks of at most BLOCK_SEEDS: a benchmark of any size costs one pass
    over the documents per block, never a shuffle of document seeds.

    Columns: ``doc_id, item_id, text_key, doc_start, item_start, n_tokens, n_equal, similarity``. Null
    or empty texts, and items under LEAST_TOKENS tokens, match nothing; rows with equal texts get equal
    results; either table may be empty.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), token_hashes(F.col(item_text_col)).alias("item"))
    items = items.where(F.size("item") >= LEAST_TOKENS)
    n_seeds, exact = items.agg(F.coalesce(F.sum(F.size("item") * len(MASKS)), F.lit(0)),
                               F.array_sort(F.collect_set(F.when(F.size("item") < SPAN, F.size("item"))))).first()
    blocks = max(1, math.ceil(n_seeds / BLOCK_SEEDS))
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                    token_hashes(F.col(text_col)).alias("tokens"))
    seeds = _seeds(d.select("text_key", "tokens"), "tokens", exact)
    size = F.size("item")
    hits = None
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks)) == b)
        block = _seeds(part.where(size >= SPAN), "item", [])
        for n in exact:
            block = block.unionByName(part.where(size == n).select(
                "item_id", F.lit(0).alias("at"), F.xxhash64(F.lit(-n), *[F.get("item", F.lit(i)) for i in range(n)]).alias("seed")))
        block = block.select("item_id", F.col("at").alias("item_at"), "seed")
        found = seeds.join(F.broadcast(block), "seed").select("text_key", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        hits = found if hits is None else hits.unionByName(found)
    hits = staged(hits.distinct(), "seed-hits")
    # hits are three numbers each; the items' tokens join only what the documents have met
    met = d.join(hits, "text_key")
    c = met.join(items, met["item_id"].eqNullSafe(items["item_id"])).drop(items["item_id"])
    first = F.greatest(F.lit(0), -F.col("shift"))
    last = F.least(F.size("item"), F.size("tokens") - F.col("shift")) - 1
    equal = F.transform(F.sequence(first, last), lambda i: F.when(F.get("tokens", i + F.col("shift")) == F.get("item", i), 1).otherwise(0))
    c = c.select("doc_id", "text_key", "item_id", "shift", first.alias("item_start"), F.size("item").alias("m"), equal.alias("equal"))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("equal") - WINDOW + 1))
    c = c.withColumns({"n_equal": total(F.col("equal")), "n_tokens": F.size("equal"),
                       "best": F.array_max(F.transform(starts, lambda s: total(F.slice("equal", s, WINDOW))))})
    whole = F.col("n_equal") >= F.when(F.col("m") < SPAN, F.col("m")).otherwise(LEAST_EQUAL * F.col("m"))
    excerpt = (F.col("n_tokens") >= WINDOW) & (F.col("best") >= LEAST_EQUAL * WINDOW)
    c = c.where(whole | excerpt).select(
        "doc_id", "item_id", "text_key", (F.col("item_start") + F.col("shift")).alias("doc_start"), "item_start",
        "n_tokens", "n_equal", (F.col("n_equal") / F.col("n_tokens")).alias("similarity"))
    best = F.struct("n_equal", -F.col("doc_start"), "doc_start", "item_start", "n_tokens", "similarity")
    return (c.groupBy("doc_id", "text_key", "item_id").agg(F.max(best).alias("x"))
            .select("doc_id", "item_id", "text_key", "x.doc_start", "x.item_start", "x.n_tokens", "x.n_equal", "x.similarity"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **cols) -> DataFrame:
    """Rows of ``docs`` whose text overlaps no benchmark item; all columns kept."""
    text = F.col(cols.get("text_col", "text"))
    bad = staged(overlaps(docs, benchmark, **cols).select("text_key").distinct(), "contaminated")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    row = docs.select(F.struct(*docs.columns).alias("row"), key.alias("text_key"))
    return row.join(bad, "text_key", "left_anti").select("row.*")
