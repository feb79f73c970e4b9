"""Toxicity: class-conditional Kneser-Ney models with shared backoff counts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import text_fold

PER_CLASS = 1500        # labelled texts of each class that the models are fitted on, at most
CLASS_BYTES = 20 << 20  # and their length together, at most
DISCOUNT = 0.75
LETTERS = 64            # continuations that the last backoff spreads over evenly
DEPTH = 14              # bytes of a word that the models tell apart; longer words are read in pieces of so many
LEAST = 3               # occurrences of a word start in both classes together, from which it is kept
WINDOW = 4              # neighbouring words over which log-likelihoods are averaged
WORST = 3               # most telling words of a text, wherever they stand, that are averaged too
KNOWN = 300_000         # words whose ratio a worker remembers

# ASCII marks and control characters stand between words.
_BLANK = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


# Scripts that set no blanks between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Bopomofo, Han, Yi.
_NO_SPACE = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\uf900-\ufaff"
                       "\U00020000-\U0003ffff]+)")


class _Marks(dict):
    """What other characters become: blanks, marks and signs a blank, invisible format characters nothing."""

    def __missing__(self, at: int) -> int | None:
        kind = unicodedata.category(chr(at))
        if at >= 128 and kind == "Cf" and at != 0x200B:
            out = None
        elif at < 128 and not chr(at).isalnum() or at == 0x200B or kind[0] in "ZPS" or kind == "Cc":
            out = 32
        else:
            out = at
        self[at] = out
        return out


_MARKS = _Marks()


def _pieces(word: str, to_end: bool) -> list[bytes]:
    """Runs of whole characters of at most DEPTH bytes, from each character on: until one reaches the end of the
    word, or (``to_end``) from all characters."""
    raw = word.encode("utf-8", "surrogatepass")
    at = [i for i, b in enumerate(raw) if b & 0xC0 != 0x80]
    out = []
    for i in at:
        end = min(i + DEPTH, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        out.append(raw[i:end])
        if end == len(raw) and not to_end:
            break
    return out


def expressions(text: str | None) -> list[bytes]:
    """Lower-cased words of a whole text without marks.

    Every byte is read: a word of more than DEPTH bytes gives a sliding window of pieces, as does each run of
    a script without blanks, where any character may begin a word.
    """
    low = (text or "").lower()
    if low.isascii():
        words = low.encode().translate(_BLANK).split()
        if len(max(words, key=len, default=b"")) <= DEPTH:
            return words
        return [x for w in words for x in ([w] if len(w) <= DEPTH else _pieces(w.decode(), False))]
    return [x for w in low.translate(_MARKS).split() for i, run in enumerate(_NO_SPACE.split(w)) if run for x in _pieces(run, i % 2 == 1)]


END = b"\x01"           # ends a word; no word holds it


@dataclass
class Ratios:
    """log(toxic / ordinary) likelihood of word starts, and of leaving the known starts there."""

    reach: dict[bytes, tuple[float, float]]

    def of(self, word: bytes) -> float:
        word += END
        for n in range(len(word), -1, -1):
            got = self.reach.get(word[:n])
            if got is not None:
                return got[0] if n == len(word) else got[0] + got[1]
        return 0.0


def kneser_ney(words: list[bytes], toxic: np.ndarray, ordinary: np.ndarray) -> Ratios:
    """Two interpolated models of how words are spelled, letter by letter after their starts.

    A class's probability of a letter after a start is its discounted share there, and the discounted
    mass goes to the shared model: the same start in both classes, each word type counted once (the
    continuation count of Kneser-Ney), which in turn backs off to an even spread. A start that a class
    never had takes the shared model as it is, so rare words differ only where the classes do.

    Works through the starts by length; starts seen fewer than LEAST times in both classes together end
    the known part there.
    """
    reach: dict[bytes, tuple[float, float]] = {}
    if not len(words):
        return Ratios(reach)
    whole = np.array([w + END for w in words], dtype=f"S{DEPTH + 1}")
    length = np.char.str_len(whole)
    names = np.array([b""], dtype="S1")
    count = np.array([[toxic.sum()], [ordinary.sum()]], np.float64)
    kinds, ratio, kept = np.array([float(len(words))]), np.zeros(1), np.ones(1, bool)
    for n in range(1, DEPTH + 3):
        rows = np.flatnonzero(length >= n)
        below, at = np.unique(whole[rows].astype(f"S{n}"), return_inverse=True)
        now = np.array([np.bincount(at, c[rows], len(below)) for c in (toxic, ordinary)])
        types = np.bincount(at, minlength=len(below)).astype(np.float64)
        up = np.searchsorted(names, below.astype(f"S{n - 1}")) if n > 1 else np.zeros(len(below), np.int64)
        children = np.bincount(up, minlength=len(names))
        # discounted mass of each start in each class; all of it where the class never had the start
        seen = np.array([np.bincount(up, c > 0, len(names)) for c in now])
        spare = np.where(count > 0, DISCOUNT * seen / np.maximum(count, 1), 1.0)
        leave = np.where(children > 0, np.log(np.where(children > 0, spare[0], 1) / np.where(children > 0, spare[1], 1)), 0.0)
        for i in np.flatnonzero(kept):
            reach[bytes(names[i])] = (float(ratio[i]), float(leave[i]))
        if not len(below):
            break
        shared = (np.maximum(types - DISCOUNT, 0) + DISCOUNT * children[up] / LETTERS) / kinds[up]
        p = np.maximum(now - DISCOUNT, 0) / np.maximum(count[:, up], 1) + spare[:, up] * shared
        ratio = ratio[up] + np.log(p[0] / p[1])
        kept = kept[up] & (now.sum(axis=0) >= LEAST)
        names, count, kinds = below, now, types
    return Ratios(reach)


def normalised(values: np.ndarray) -> tuple[float, float, float]:
    """Means of the log-likelihood differences: of the WORST words, of the worst WINDOW neighbours, of all.

    A text of fewer words is averaged over as many places all the same: one word is weak evidence.
    """
    if not len(values):
        return 0.0, 0.0, 0.0
    worst = float(np.sort(values)[-WORST:].sum()) / WORST
    if len(values) <= WINDOW:
        return worst, float(values.sum()) / WINDOW, float(values.mean())
    total = np.concatenate([[0.0], np.cumsum(values)])
    return worst, float((total[WINDOW:] - total[:-WINDOW]).max()) / WINDOW, float(values.mean())


EVIDENCE = ("worst", "window", "mean", "length")


def evidence(text: str | None, ratios: Ratios, known: dict[bytes, float]) -> tuple[float, ...]:
    """Length-normalised log-likelihood differences of a whole text, and the log of its length."""
    values = []
    for w in expressions(text):
        r = known.get(w)
        if r is None:
            if len(known) >= KNOWN:
                known.clear()
            r = known[w] = ratios.of(w)
        values.append(r)
    return *normalised(np.array(values)), float(np.log1p(len(values)))


@dataclass
class Model:
    ratios: Ratios
    weights: np.ndarray    # of the evidences and 1
    scale: np.ndarray      # mean and spread of the evidences

    def score(self, text: str | None, known: dict[bytes, float]) -> float:
        x = (np.array(evidence(text, self.ratios, known)) - self.scale[0]) / self.scale[1]
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, parts: int, hold: int) -> DataFrame:
    """(text, label, half) of the labelled texts to learn from: by a hash of the id, within both bounds."""
    known = (labels.where(F.col(label_col).isin(0, 1) & (text_fold(id_col, parts) != hold)).groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other")).where("label = other")
             .select("id", "label", F.xxhash64("id").alias("order")))
    ids = None
    for y in (0, 1):
        part = known.where(F.col("label") == y).orderBy("order", "id").limit(PER_CLASS)
        ids = part if ids is None else ids.unionByName(part)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    sizes = Window.partitionBy("label").orderBy("order", "id", F.xxhash64("text"))
    within = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(sizes) <= CLASS_BYTES
    return (found.withColumn("within", within).where("within and text is not null")
            .select("text", "label", F.pmod("order", F.lit(2)).cast("int").alias("half")))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for text, label, half in zip(pdf["text"], pdf["label"], pdf["half"]):
            words, n = np.unique(np.array(expressions(text), dtype=f"S{DEPTH}"), return_counts=True)
            yield pd.DataFrame({"word": [bytes(w) for w in words], "label": label, "half": half, "n": n})


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
          hold_parts: int = 4, hold: int = 2) -> Model:
    """Fit on at most PER_CLASS labelled texts (CLASS_BYTES together) of each class outside the held-out fold.

    Word counts are made on the executors. The calibration sees ratios of models that were fitted on the
    other half of the sample, so it knows how new texts behave; the final model knows both halves.
    Without labels of both classes every score is 0.5 or lower.
    """
    sample = _sample(docs, labels, label_col, id_col, text_col, hold_parts, hold).persist()
    table = (sample.mapInPandas(_counted, "word binary, label int, half int, n long").groupBy("word")
             .agg(*[F.sum(F.when((F.col("label") == y) & (F.col("half") == h), F.col("n")).otherwise(0)).alias(f"n{y}{h}")
                    for y in (0, 1) for h in (0, 1)]).toPandas())
    words = [bytes(w) for w in table["word"]]
    order = sorted(range(len(words)), key=words.__getitem__)
    words = [words[i] for i in order]
    n = {c: table[c].to_numpy(np.int64)[order] for c in ("n00", "n01", "n10", "n11")}

    def fitted(halves: tuple[int, ...]) -> Ratios:
        t, o = (sum(n[f"n{y}{h}"] for h in halves) if len(words) else np.zeros(0, np.int64) for y in (1, 0))
        some = np.flatnonzero(t + o)
        return kneser_ney([words[i] for i in some], t[some], o[some])

    crossed = docs.sparkSession.sparkContext.broadcast([fitted((1,)), fitted((0,))])

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: tuple[dict, dict] = ({}, {})
        for pdf in batches:
            rows = [(*evidence(t, crossed.value[h], known[h]), y) for t, h, y in zip(pdf["text"], pdf["half"], pdf["label"])]
            yield pd.DataFrame(rows, columns=[*EVIDENCE, "label"])

    got = sample.mapInPandas(seen, ", ".join(f"{e} double" for e in EVIDENCE) + ", label int").toPandas()
    sample.unpersist()
    got = got.sort_values(list(got.columns))
    x, y = got[list(EVIDENCE)].to_numpy(np.float64), got["label"].to_numpy(np.float64)
    weights, scale = _logistic(x, y)
    return Model(fitted((0, 1)), weights, scale)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Regularised logistic regression by Newton steps; (weights, [mean, spread])."""
    if not len(y) or y.min() == y.max():
        flat = np.zeros(x.shape[1] + 1)
        flat[-1] = -1.0 if not len(y) or y[0] == 0 else 1.0
        return flat, np.array([flat[:-1], flat[:-1] + 1])
    scale = np.array([x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)])
    z = np.hstack([(x - scale[0]) / scale[1], np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * len(y) * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w, scale


def scored(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
           hold_parts: int = 4, hold: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row, from its whole text alone.

    The models (word starts of the bounded sample) are broadcast. Null and empty texts get the score of
    no evidence. One pass with no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in batches:
            s = [shared.value.score(t, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64())],
                                             ["doc_id", "held_out", "score"])

    d = docs.select(F.col(id_col).alias("doc_id"), (text_fold(id_col, hold_parts) == hold).alias("held_out"), F.col(text_col).alias("text"))
    out = d.mapInArrow(score, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
