"""Language of texts: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import chunks, fold, stored

BUCKETS = 1 << 15
#: Languages whose log probabilities are held and sent at once.
COLUMNS = 256
UNKNOWN = "und"
#: Odd multipliers of the n-gram hash (fixed values).
MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
BLOCK_BYTES = 1 << 20


def _letters() -> np.ndarray:
    """Whether each code point of the basic plane is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


class Grams:
    """Buckets of the 1- to 3-grams of a text; runs of anything but letters count as one space."""

    def __init__(self, buckets: int):
        self.shift, self.letters = np.uint32(33 - buckets.bit_length()), _letters()

    def __call__(self, text: str) -> np.ndarray:
        """Empty if the text has no letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        letter = self.letters[np.minimum(codes, 0xFFFF)]
        high = np.flatnonzero(codes > 0xFFFF)
        letter[high] = [chr(c).isalpha() for c in codes[high].tolist()]
        if not letter.any():
            return np.empty(0, np.int64)
        codes = np.where(letter, codes, np.uint32(32))
        codes = codes[letter | np.concatenate(([True], letter[:-1]))]
        codes = np.concatenate((np.uint32([32]), codes, np.uint32([32])))
        one = codes * MIX[0]
        two = one[:-1] + codes[1:] * MIX[1]
        three = two[:-1] + codes[2:] * MIX[2]
        return np.concatenate([(h ^ (h >> np.uint32(15))) * MIX[1] >> self.shift for h in (one[1:-1], two, three)]).astype(np.int64)


def counted(docs: DataFrame, buckets: int) -> DataFrame:
    """``lang, bucket, n`` over all rows; bucket -1 counts documents. One row per task and pair, then sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, totals, seen = Grams(buckets), {}, {}
        for batch in chunks(batches, limit=BLOCK_BYTES):
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = grams(text)
                if len(found):
                    by_lang.setdefault(lang, []).append(found)
                    seen[lang] = seen.get(lang, 0) + 1
            for lang, found in by_lang.items():
                totals[lang] = totals.get(lang, 0) + np.bincount(np.concatenate(found), minlength=buckets)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(counts[at], seen[lang]))], ["lang", "bucket", "n"])

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model(NamedTuple):
    """Languages in bytewise order, their log priors, and the stored counts that the log probabilities come from."""

    langs: list[str]
    prior: np.ndarray
    counts: DataFrame
    buckets: int
    smoothing: float

    def columns(self, start: int, stop: int) -> np.ndarray:
        """Log probabilities by bucket of the languages from ``start`` to ``stop``."""
        names = self.langs[start:stop]
        matrix = np.full((self.buckets, len(names)), self.smoothing)
        if names:
            codes = self.counts.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "lang string, code int")
            some = self.counts.filter((F.col("bucket") >= 0) & F.col("lang").between(names[0], names[-1]))
            rows = some.join(codes, "lang").select("bucket", "code", "n").toArrow()
            matrix[rows.column("bucket").to_numpy(), rows.column("code").to_numpy()] += rows.column("n").to_numpy()
        return np.log(matrix / matrix.sum(axis=0)).astype(np.float32)


def learned(docs: DataFrame, buckets: int = BUCKETS, smoothing: float = 0.5) -> Model:
    """Counts of all rows, summed in Spark; the driver gets the names of the languages and their numbers of documents."""
    counts = stored(counted(docs, buckets), "grams")
    seen = counts.filter("bucket = -1").orderBy("lang").select("lang", "n").collect()
    prior = np.array([r[1] for r in seen], np.float64)
    return Model([r[0] for r in seen], np.log(prior / max(1.0, prior.sum())), counts, buckets, smoothing)


def predicted(docs: DataFrame, model: Model, columns: int = COLUMNS) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row: the likeliest language and its posterior probability.

    A text that is null or has no letter, and any text if nothing was learned, is ``und`` with score 0. Of equally likely
    languages the first by name is taken. Only ``doc_id`` and ``text`` are read.

    The matrix is sent in blocks of ``columns`` languages, 32 MB each with the usual buckets. With more languages the texts are
    written with their best language so far and the sum of shares, and meet the next block; any number of languages is scored.
    """
    state = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(UNKNOWN).alias("lang_pred"),
        F.lit(float("-inf")).alias("best"), F.lit(0.0).alias("total"))
    schema = "doc_id long, text string, lang_pred string, best double, total double"
    for start in range(0, len(model.langs), columns):
        stop = min(start + columns, len(model.langs))
        sent = docs.sparkSession.sparkContext.broadcast((model.langs[start:stop], model.prior[start:stop], model.columns(start, stop)))
        last = stop == len(model.langs)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            langs, prior, matrix = sent.value
            grams = Grams(len(matrix))
            for batch in chunks(batches, limit=BLOCK_BYTES):
                found = [grams(t) if t else np.empty(0, np.int64) for t in batch.column("text").to_pylist()]
                sizes = np.array([len(f) for f in found])
                some = np.flatnonzero(sizes)
                names, best, total = batch.column("lang_pred").to_pylist(), batch.column("best").to_numpy().copy(), batch.column("total").to_numpy().copy()
                if len(some):
                    starts = np.cumsum(sizes[some]) - sizes[some]
                    logs = np.add.reduceat(matrix[np.concatenate([found[i] for i in some])], starts, axis=0, dtype=np.float64) + prior
                    top, at = logs.max(axis=1), logs.argmax(axis=1)
                    high = np.maximum(top, best[some])
                    for i in np.flatnonzero(top > best[some]).tolist():
                        names[some[i]] = langs[at[i]]
                    total[some] = total[some] * np.exp(best[some] - high) + np.exp(logs - high[:, None]).sum(axis=1)
                    best[some] = high
                texts = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, pa.array(names, pa.string()), pa.array(best), pa.array(total)], ["doc_id", "text", "lang_pred", "best", "total"])

        state = state.mapInArrow(run, schema)
        if not last:
            state = stored(state, "languages")
            sent.destroy()
    return state.select("doc_id", "lang_pred", F.when(F.col("total") > 0, 1 / F.col("total")).otherwise(0.0).alias("score"))


def identified(docs: DataFrame, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from ``lang`` of the rows outside the held-out fold, predicted for all.

    A row without id is in no fold: it isn't learned from and not held out.
    """
    model = learned(docs.filter(fold() != held_out))
    found = predicted(docs, model)
    return found.select("doc_id", F.coalesce(fold() == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
