"""Substring dedup: paragraph MinHash banding, exact Jaccard, components of removals."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm import ngram_join
from meterstar.llm.common import components, drop_staged, mixed, shingle_hashes, staged, word_bytes, word_hashes

SHINGLE = 5
SIMILARITY = (80, 100)  # paragraphs link when 100 * intersection >= 80 * union of their shingles
RECALL = 0.99           # share of linked pairs that meet in a band at least
ROWS = 2                # MinHashes of a band
LONG_LINE = 20          # a line of so many words ends a piece
CUT_REACH = 6           # a content-defined cut is the smallest hash so many words to either side
MOST_WORDS = 64         # a piece without any cut is cut after so many words
LEAST_WORDS = 6         # shorter pieces are no repeats by themselves
LEAST_RUN = 16          # words of a paragraph, and of neighbouring repeats together, at least


def bands(similarity: float, recall: float, rows: int = 1) -> int:
    """Bands of so many MinHashes that let pairs of this similarity meet with this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))


BANDS = bands(SIMILARITY[0] / SIMILARITY[1], RECALL, ROWS)
_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
BLOCK = 1 << 16         # words of neighbouring documents that are worked through at once
_POWERS = np.cumprod(np.full(MOST_WORDS, 0x9E3779B97F4A7C15, np.uint64))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))  # undoes a factor _BASE


def _lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a whole text (A-Z lower-cased) and the words of each line."""
    lines = [line.split() for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]
    return word_hashes([w for line in lines for w in line]), np.array([len(line) for line in lines])


def _pieces(h: np.ndarray, sizes: np.ndarray, doc_ends: np.ndarray) -> np.ndarray:
    """Where pieces begin in the words of several documents, one after another; no cut looks beyond its document."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    long = sizes >= LONG_LINE
    forced = np.unique(np.concatenate([[0, n], doc_ends, ends[long], (ends - sizes)[long]]))
    inner = np.zeros(0, np.int64)
    if n > 2 * CUT_REACH:
        pair = mixed(h[:-1] * np.uint64(3) + h[1:])
        pair[doc_ends[(doc_ends > 0) & (doc_ends < n)] - 1] = np.uint64(2**64 - 1)
        pair = np.append(pair, np.full(CUT_REACH, np.uint64(2**64 - 1)))
        two = np.minimum(pair[:-1], pair[1:])
        four = np.minimum(two[:-2], two[2:])
        six = np.minimum(four[:-2], four[2:])  # the smallest of CUT_REACH pairs from each on
        mid = pair[CUT_REACH: len(six) - 1]
        inner = np.flatnonzero((mid < six[: len(mid)]) & (mid <= six[CUT_REACH + 1: CUT_REACH + 1 + len(mid)])) + CUT_REACH
        # the few words beside an end of a long line stay with their neighbours
        after = np.searchsorted(forced, inner, "right")
        inner = inner[(inner - forced[after - 1] >= LEAST_WORDS) & (forced[after] - inner > LEAST_WORDS)]
    at = np.sort(np.concatenate([forced[:-1], inner]))
    gaps = np.diff(np.append(at, n))
    wide = np.flatnonzero(gaps > MOST_WORDS)
    if len(wide):
        at = np.sort(np.concatenate([at, *[np.arange(at[i] + MOST_WORDS, at[i] + gaps[i], MOST_WORDS) for i in wide]]))
    return at


def split_paragraphs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a whole text and the places of words that begin a piece.

    Pieces end with long lines, and where the hash of a word pair is the smallest around: cuts
    that depend on nearby words alone, so a passage is cut alike wherever it stands, also inside
    other paragraphs.
    """
    h, sizes = _lines(text)
    return h, _pieces(h, sizes, np.array([len(h)]))


def natural_paragraphs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of a text's lines, and of its blocks of lines between blank lines where it has any, of LEAST_RUN words."""
    ends = np.cumsum(sizes)
    begin, end = ends - sizes, ends
    blank = sizes == 0
    if blank[:-1].any():
        block = np.cumsum(blank)
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        several = np.add.reduceat(~blank, first) > 1
        last = np.append(first[1:], len(sizes)) - 1
        begin, end = np.append(begin, begin[first][several]), np.append(end, ends[last][several])
    long = end - begin >= LEAST_RUN
    return begin[long], end[long]


def piece_keys(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(begin, words, key) of the pieces that have LEAST_WORDS words."""
    size = np.diff(np.append(at, len(h)))
    long = size >= LEAST_WORDS
    if not long.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place = np.arange(len(h)) - np.repeat(at, size)
    return at[long], size[long], mixed(np.add.reduceat(h * _POWERS[place], at)[long] + size[long].astype(np.uint64))


def paragraph_keys(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, band hashes) of the natural paragraphs at these places."""
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros((0, BANDS), np.uint64)
    # a sum of words times powers, moved to the same start for every paragraph
    total = np.append(np.uint64(0), np.cumsum(h * np.cumprod(np.append(np.uint64(1), np.full(len(h) - 1, _BASE)))))
    key = (total[end] - total[begin]) * np.cumprod(np.append(np.uint64(1), np.full(int(begin.max()), _BACK)))[begin]
    s = np.append(shingle_hashes(h, SHINGLE), np.uint64(0))  # one more, so that every span ends within
    span = np.stack([begin, end - SHINGLE + 1], axis=1).ravel()
    low = [np.minimum.reduceat(s * seed, span)[::2] for seed in _SEEDS]  # an odd factor orders spread hashes anew
    band = []
    for i in range(BANDS):
        x = np.full(len(begin), i + 1, np.uint64)
        for m in low[i * ROWS: (i + 1) * ROWS]:
            x = mixed(x * _BASE + m)
        band.append(x)
    return mixed(mixed(key) + (end - begin).astype(np.uint64)), np.stack(band, axis=1)


def _paragraphs(texts: DataFrame) -> DataFrame:
    """One row per piece and natural paragraph: doc_id, text_key, begin, words, key and its bands (null for pieces)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, some, n = 0, [], 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                some.append(_lines(text))
                n += len(some[-1][0])
                if n >= BLOCK or i + 1 == batch.num_rows:
                    yield keyed(batch.slice(first, len(some)), some)
                    first, some, n = i + 1, [], 0

    def keyed(docs: pa.RecordBatch, lines: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h = np.concatenate([x for x, _ in lines])
        doc_ends = np.cumsum([len(x) for x, _ in lines])
        starts = doc_ends - [len(x) for x, _ in lines]
        begin, words, key = piece_keys(h, _pieces(h, np.concatenate([x for _, x in lines]), doc_ends))
        natural = [natural_paragraphs(x) for _, x in lines]
        b, e = (np.concatenate([x[j] + at for x, at in zip(natural, starts)]) for j in (0, 1))
        k, band = paragraph_keys(h, b, e)
        place = np.concatenate([begin, b]).astype(np.int64)
        doc = np.searchsorted(doc_ends, place, "right")
        piece, at = np.arange(len(place)) < len(begin), pa.array(doc)
        band = np.concatenate([np.zeros((len(begin), BANDS), np.uint64), band])
        return pa.RecordBatch.from_arrays(
            [docs.column("doc_id").take(at), docs.column("text_key").take(at), pa.array(place - starts[doc]),
             pa.array(np.concatenate([words, e - b]).astype(np.int64)), pa.array(np.concatenate([key, k]).view(np.int64)),
             *[pa.array(np.ascontiguousarray(band[:, i]).view(np.int64), mask=piece) for i in range(BANDS)]],
            ["doc_id", "text_key", "begin", "words", "key", *_BANDS])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(cut, f"doc_id {kind}, text_key long, begin long, words long, key long, " + ", ".join(f"{b} long" for b in _BANDS))


_BANDS = [f"b{i}" for i in range(BANDS)]


def _shingled(places: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, shingles) of one paragraph per key, cut again from its document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                h = word_hashes(word_bytes(text))
                for w in wanted:
                    keys.append(w["key"])
                    sets.append(np.unique(shingle_hashes(h[w["begin"]: w["begin"] + w["words"]], SHINGLE)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])

    # a document's paragraphs together, so that its text is sent once
    wanted = places.groupBy("doc", "doc_key").agg(F.collect_list(F.struct("key", "begin", "words")).alias("wanted"))
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc"]) & (texts["text_key"] == wanted["doc_key"]))
    cut_again = found.select("text", "wanted").mapInArrow(cut, "key long, shingles array<long>")
    return cut_again.groupBy("key").agg(F.first("shingles").alias("shingles"))


def _worded(places: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text) of one paragraph per key: its words, cut again from its document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                words = word_bytes(text)
                for w in wanted:
                    keys.append(w["key"])
                    found.append(b" ".join(words[w["begin"]: w["begin"] + w["words"]]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.string())], ["key", "text"])

    wanted = places.groupBy("doc", "doc_key").agg(F.collect_list(F.struct("key", "begin", "words")).alias("wanted"))
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc"]) & (texts["text_key"] == wanted["doc_key"]))
    return found.select("text", "wanted").mapInArrow(cut, "key long, text string").groupBy("key").agg(F.first("text").alias("text"))


def _beside_hubs(pairs: DataFrame, links: DataFrame, places: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among the classes that met at a hub to which not all of them link.

    A hub says nothing about two classes that both miss it, nor about one that misses it and one that
    does not. All classes of such a hub go through the exact join of ``ngram_join``, which lists them
    under their rarest shingles, so a shingle that thousands share brings nobody together.
    """
    met = pairs.join(links.withColumn("linked", F.lit(1)), ["a", "b"], "left")
    open_ = met.groupBy("b").agg(F.count("*").alias("n"), F.count("linked").alias("m")).where("n > 1 AND m < n").select("b")
    left = staged(pairs.join(open_, "b").select(F.col("a").alias("key")).distinct(), "beside-hubs")
    if left.isEmpty():
        return links.limit(0)
    words = staged(_worded(places.join(left, "key"), texts), "paragraph-words")
    member = ngram_join._members(words, "key", "text")
    first = member.groupBy("root").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("last")).where("b <> last").select("root", "b")
    found = staged(member.join(first, "root").select(F.col("doc_id").alias("a"), "b").where("a <> b"), "links-beside-hubs")
    for t in (left, words, member):
        drop_staged(t)
    return found


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of whole texts that repeat, exactly or nearly, across the table: one row per passage.

    Two kinds of places are compared. Natural paragraphs (lines, and blocks between blank lines, of LEAST_RUN
    words) meet by MinHash banding: paragraphs of equal words are one class, every class of a band is compared
    with the band's smallest class by exact Jaccard over five-word shingles, at 0.8; where some classes do not
    link to it (common shingles brought them together), all classes that met there are joined exactly. Pieces
    (see ``split_paragraphs``) find what repeats word for word inside other paragraphs: pieces of equal words
    are one class. Classes and links form components; the smallest place (doc_id, text hash, begin) of a
    component is kept, the others are removals. What a single document repeats within itself alone is no
    repeat across documents and is left alone. Repeated places of a document that overlap or touch are one
    passage if they have LEAST_RUN words together; shorter repeats (a common line) are left alone.

    Returns ``doc_id, begin_word, n_words, n_paragraphs, removed_words, kept_doc_ids``: the passage's
    place in words of the text, how many of its words are removals, and the documents that
    keep its paragraphs. Null or empty texts have no passages; rows that repeat an id and text count
    as one document; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))
    every = staged(_paragraphs(texts), "paragraphs")
    place = F.struct("doc_id", "text_key", "begin")

    # one row per class; a piece that stands in one place only is nothing
    classes = staged(every.groupBy("key").agg(F.min(F.struct(place.alias("lo"), "words")).alias("x"), F.max(place).alias("hi"),
                                              *[F.first(b).alias(b) for b in _BANDS])
                     .where(F.col("b0").isNotNull() | (F.col("x.lo") != F.col("hi"))).select("key", "x.lo", "x.words", "hi", *_BANDS), "classes")

    # links between classes: the classes of a band meet its smallest one
    low = classes.where("b0 is not null").select("key", F.explode(F.array(*_BANDS)).alias("band"))
    hubs = staged(low.groupBy("band").agg(F.min("key").alias("hub"), F.max("key").alias("last")).where("hub <> last").select("band", "hub"), "hubs")
    pairs = staged(low.join(hubs, "band").where("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct(), "band-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    places = staged(classes.join(ends, "key").select(
        "key", F.col("lo.doc_id").alias("doc"), F.col("lo.text_key").alias("doc_key"), F.col("lo.begin").alias("begin"), "words"), "places")
    sets = staged(_shingled(places, texts), "paragraph-sets")
    both = (pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    links = staged(both.where(SIMILARITY[1] * common >= SIMILARITY[0] * (F.size("x") + F.size("y") - common)).select("a", "b"), "paragraph-links")
    beside = _beside_hubs(pairs, links, places, texts)
    roots = staged(components(links.union(beside)).withColumnRenamed("node", "key"), "paragraph-roots")

    # components found in two documents or more; sums are partial, so one passage in a third of all rows is no hot task
    named = staged(classes.select("key", "lo", "hi").join(roots, "key", "left").where((F.col("lo") != F.col("hi")) | F.col("root").isNotNull())
                   .select("key", "lo", "hi", F.coalesce("root", "key").alias("root")), "named-classes")
    kept = named.groupBy("root").agg(F.min("lo").alias("keep"), F.max("hi").alias("other")).where(
        F.struct("keep.doc_id", "keep.text_key") != F.struct("other.doc_id", "other.text_key"))
    repeated = staged(named.join(kept, "root").select("key", "keep"), "repeated")
    # each place once: rows that repeat an id and text in any number are one document
    found = every.select("doc_id", "text_key", "begin", "words", "key").join(repeated, "key").distinct()

    # repeated places of a document that overlap or touch, in order; words of several removals count once
    doc = Window.partitionBy("doc_id", "text_key").orderBy("begin", "words")
    before = doc.rowsBetween(Window.unboundedPreceding, -1)
    own, end = place == F.col("keep"), F.col("begin") + F.col("words")
    found = found.select("doc_id", "text_key", "begin", "words", "keep", end.alias("end"), own.alias("own"))
    covered = F.max(F.when(~F.col("own"), F.col("end"))).over(before)
    found = found.withColumns({
        "fresh": F.when(F.col("begin") <= F.max("end").over(before), 0).otherwise(1),
        "other": F.when((F.lag("begin").over(doc) == F.col("begin")) & (F.lag("words").over(doc) == F.col("words")), 0).otherwise(1),
        "gone": F.when(F.col("own"), 0).otherwise(F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(covered, F.lit(0)))))})
    found = found.withColumn("run", F.sum("fresh").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    runs = found.groupBy("doc_id", "text_key", "run").agg(
        F.min("begin").alias("begin_word"), (F.max("end") - F.min("begin")).alias("n_words"), F.sum("other").alias("n_paragraphs"),
        F.sum("gone").alias("removed_words"), F.array_sort(F.collect_set("keep.doc_id")).alias("kept_doc_ids"))
    out = staged(runs.where(F.col("n_words") >= LEAST_RUN).select(
        "doc_id", "begin_word", "n_words", "n_paragraphs", "removed_words", "kept_doc_ids"), "passages")
    for t in (every, classes, hubs, pairs, places, sets, links, beside, roots, named, repeated):
        drop_staged(t)
    return out
