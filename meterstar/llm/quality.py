"""Quality classifier: nearest-neighbour voting among latent-semantic vectors of labelled texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import text_fold

PER_CLASS = 1000       # labelled texts of each class that the classifier is fitted on, at most
RANK = 64              # latent dimensions
NEIGHBOURS = 15
SHARPNESS = 4          # similarities vote with this power
BLOCK = 512            # documents whose cosine products are computed at once

_CLASSES = 64
_PAIRS = _CLASSES * _CLASSES
_SHAPE = 48            # bins for repetition: of words, of neighbouring words, of lines
WIDTH = _PAIRS + _SHAPE


def _byte_classes() -> np.ndarray:
    """Lower-case letters one by one, capitals, digits and non-ASCII bytes as one class each, marks one by one."""
    table, marks = np.zeros(256, np.int64), 31
    for b in range(256):
        c = chr(b)
        if b >= 128:
            table[b] = 30
        elif c.islower():
            table[b] = b - 97
        elif c.isupper():
            table[b] = 26
        elif c.isdigit():
            table[b] = 27
        elif c == "\n":
            table[b] = 28
        elif c.isspace() or b < 32:
            table[b] = 29
        else:
            table[b] = marks
            marks = min(marks + 1, _CLASSES - 1)
    return table


_TABLE = _byte_classes()


def features(text: str | None) -> np.ndarray:
    """Term counts of a whole text: pairs of byte classes, and three shares of repetition in bins."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(WIDTH, np.float32)
    if not raw:
        return out
    c = _TABLE[np.frombuffer(raw, np.uint8)]
    out[:_PAIRS] = np.bincount(c[:-1] * _CLASSES + c[1:], minlength=_PAIRS)
    words, lines = raw.split(), raw.split(b"\n")
    shares = (len(set(words)) / max(1, len(words)), sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)),
              len(set(lines)) / len(lines))
    per = _SHAPE // 3
    for i, x in enumerate(shares):
        out[_PAIRS + per * i + min(per - 1, int(per * x))] = len(words)
    return out


@dataclass
class Model:
    weight: np.ndarray     # inverse document frequencies
    basis: np.ndarray      # WIDTH x RANK
    vectors: np.ndarray    # labelled texts, unit length
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        z = x @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled texts, weighted by similarity; ties by all equals alike."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        base = float(self.labels.mean())
        near = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        least = -np.partition(-near, k - 1, axis=1)[:, k - 1: k]
        votes = np.where(near >= least, np.maximum(near, 0), 0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        out = (votes @ self.labels + 1e-9 * base) / (total + 1e-9)
        return np.where(counts.any(axis=1), np.clip(out, 0, 1), base)


def fit(counts: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Weights, truncated SVD by subspace iteration, and the latent vectors of the labelled texts."""
    weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = np.log1p(counts) * weight
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    q = np.random.default_rng(seed).normal(size=(WIDTH, RANK + 16)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q)) if len(x) else (q, None)
    if len(x):
        _, _, v = np.linalg.svd(x @ q, full_matrices=False)
        q = q @ v.T
    model = Model(weight, np.ascontiguousarray(q[:, :RANK]), np.zeros((0, RANK), np.float32), labels.astype(np.float64))
    model.vectors = model.latent(counts)
    return model


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"label": pdf["label"], "order": pdf["order"],
                            "counts": [features(t).tobytes() for t in pdf["text"]]})


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
          hold_parts: int = 3, hold: int = 1) -> Model:
    """Fit on at most PER_CLASS labelled texts of each class, chosen by a hash of the id, outside the held-out fold.

    Ids with null or contradicting labels teach nothing; a table without labels gives the score 0.5.
    """
    known = (labels.where(F.col(label_col).isin(0, 1) & (text_fold(id_col, hold_parts) != hold)).groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other")).where("label = other")
             .select("id", "label", F.xxhash64("id").alias("order")))
    rows = []
    for y in (0, 1):
        ids = known.where(F.col("label") == y).orderBy("order", "id").limit(PER_CLASS)
        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
        got = found.select("text", "label", "order").mapInPandas(_counted, "label long, order long, counts binary")
        rows.append(got.orderBy("order", "counts").limit(PER_CLASS).toPandas())
    rows = pd.concat(rows)
    counts = np.stack([np.frombuffer(b, np.float32) for b in rows["counts"]]) if len(rows) else np.zeros((0, WIDTH), np.float32)
    return fit(counts, rows["label"].to_numpy(np.float64))


def scored(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
           hold_parts: int = 3, hold: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row; the model (a few MB, bounded) is broadcast.

    Every product with every labelled vector is computed, BLOCK documents at a time. Whole texts
    count. A null or empty text gets the share of label 1 among the labelled texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                s = shared.value.score(np.stack([features(t) for t in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s, pa.float64())],
                                                 ["doc_id", "held_out", "score"])

    d = docs.select(F.col(id_col).alias("doc_id"), (text_fold(id_col, hold_parts) == hold).alias("held_out"), F.col(text_col).alias("text"))
    out = d.mapInArrow(score, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, with all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                s = shared.value.score(np.stack([features(t) for t in part.column(text_col).to_pylist()]))
                yield part.filter(pa.array(s >= threshold))

    return docs.mapInArrow(keep, docs.schema)
