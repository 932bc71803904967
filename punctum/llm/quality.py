"""Quality of texts: votes of the nearest labelled texts in a latent space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import chunks, fold, raw

SAMPLE = 4000
RANK = 48
NEIGHBOURS = 15
SHARPNESS = 8
ACCEPTED = 0.3
BLOCK_BYTES = 2 << 20
#: Texts of a product with the sample, and steps to which cosines are rounded.
BLOCK_ROWS = 1024
STEPS = 1 << 18
#: Marks that are a class of bytes each; the other classes are space, line end, lower, upper, digit, not ASCII and the rest.
MARKS = b".,;:!?|*$&%#@+-_/(){}[]<>\"'="
CLASSES = 7 + len(MARKS)
LAGS = (1, 2, 3, 4)
REPEATS = 4
TERMS = CLASSES * CLASSES + REPEATS * (len(LAGS) + 2)


def _class(byte: int) -> int:
    kinds = (byte == 32, byte == 10, 97 <= byte <= 122, 65 <= byte <= 90, 48 <= byte <= 57, byte >= 128)
    return 6 + MARKS.index(byte) if byte in MARKS else kinds.index(True) if any(kinds) else CLASSES - 1


TABLE = bytes(map(_class, range(256)))


def terms(text: bytes) -> np.ndarray:
    """Term weights of a whole text: pairs of neighbouring byte classes, and words that come again.

    Logarithms of counts; how often a word equals the one a few places before, and ten times the shares
    of such words and of words seen before, are terms of ``REPEATS`` columns each. A text without bytes has none.
    """
    out = np.zeros(TERMS, np.float32)
    if len(text) > 1:
        kinds = np.frombuffer(text.translate(TABLE), np.uint8).astype(np.int16)
        out[: CLASSES * CLASSES] = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
    seen: dict[bytes, int] = {}
    words = text.lower().split()
    number = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    again = [int((number[lag:] == number[:-lag]).sum()) for lag in LAGS]
    n = max(1, len(words))
    out[CLASSES * CLASSES :] = np.repeat([*again, 10 * again[0] / n, 10 * (n - len(seen)) / n if words else 0], REPEATS)
    return np.log1p(out)


@dataclass
class Neighbours:
    """Inverse document frequencies, the latent axes, and the unit vectors and labels of the sample."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    mean: float

    def place(self, rows: np.ndarray) -> np.ndarray:
        rows = (rows * self.weights) @ self.axes
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def scores(self, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Labels of the nearest vectors by cosine, weighted by a power of it; the mean label where none is near.

        Cosines are rounded to ``STEPS`` steps of 1, so equal texts have equal scores wherever they lie in a block. Of equal
        cosines at the last place the smaller ``doc_id`` counts: vectors are in their order.
        """
        n = len(self.labels)
        if not n:
            return np.full(len(rows), self.mean)
        k, out = min(neighbours, n), np.empty(len(rows))
        kind = np.int32 if (STEPS + 1) * n < 2**31 else np.int64
        for at in range(0, len(rows), BLOCK_ROWS):
            cosine = self.place(rows[at : at + BLOCK_ROWS]) @ self.vectors.T
            ranks = np.rint(np.clip(cosine, 0, 1) * STEPS).astype(kind) * kind(n) + np.arange(n - 1, -1, -1, dtype=kind)
            ranks.partition(n - k, axis=1)
            near, place = np.divmod(ranks[:, n - k :], kind(n))
            weight = (near / STEPS) ** SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[n - 1 - place]).sum(axis=1)
            out[at : at + BLOCK_ROWS] = np.clip(np.where(total > 1e-9, votes / np.maximum(total, 1e-9), self.mean), 0, 1)
        return out


def fitted(rows: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Neighbours:
    """Latent semantic axes of the sample: leading eigenvectors of the weighted term products."""
    if not len(labels):
        return Neighbours(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    weights = np.log1p(1 / ((rows > 0).mean(axis=0) + 1e-3)).astype(np.float32)
    unit = rows * weights
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)
    axes = np.linalg.eigh(unit.T.astype(np.float64) @ unit)[1][:, -rank:].astype(np.float32)
    model = Neighbours(weights, axes, np.empty(0), labels, float(labels.mean()))
    model.vectors = model.place(rows)
    return model


def learned(docs: DataFrame, labels: DataFrame, held_out: int | None = 0, sample: int = SAMPLE) -> Neighbours:
    """Fit on at most ``sample`` labelled rows outside the held-out fold, the smallest by a hash of the id.

    Several labels of one id count as their mean; null labels and ids, and labels without a document, are left out.
    Only the ids and term weights of the sample reach the driver.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    marked = marked.filter(fold() != held_out) if held_out is not None else marked
    marked = marked.groupBy("doc_id").agg(F.avg("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = marked.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([terms(t).tobytes() for t in raw(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), values], ["doc_id", "label", "terms"])

    picked = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, label double, terms binary")
    found = picked.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("terms").alias("terms")).toArrow().sort_by("doc_id")
    rows = np.frombuffer(b"".join(found.column("terms").to_pylist()), np.float32).reshape(-1, TERMS)
    return fitted(rows, found.column("label").to_numpy())


def _score(batch: pa.RecordBatch, model: Neighbours) -> np.ndarray:
    return model.scores(np.stack([terms(t) for t in raw(batch.column("text"))]))


def scored(docs: DataFrame, model: Neighbours) -> DataFrame:
    """``doc_id, score``, one row for each row of ``docs``; a null or empty text scores the mean label of the sample.

    The labelled vectors, at most ``sample`` of ``RANK`` numbers, are broadcast; each block of documents meets all
    of them in one matrix product. Only ``doc_id`` and ``text`` are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_score(batch, sent.value))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, held_out: int = 0, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted``: all of ``docs``, learned outside the held-out fold.

    A row without id is not held out. Without any labelled document the score is 0.5.
    """
    found = scored(docs, learned(docs, labels, held_out, sample))
    return found.select(
        "doc_id", F.coalesce(fold() == held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= ACCEPTED, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, held_out: int | None = 0, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score at least ``ACCEPTED``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(learned(docs, labels, held_out, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BLOCK_BYTES):
            yield batch.filter(pa.array(_score(batch, sent.value) >= ACCEPTED))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)
