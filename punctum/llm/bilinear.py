"""Scores of texts by a log-bilinear language model, trained by noise-contrastive estimation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import chunks, fold, raw, stored

#: The end of a text as a token: no word holds a space.
END = b" "
LISTED = 1 << 16
LISTED_BYTES = 64
CLASSES = 512
WIDTH = 24
NOISE = 32
BATCH = 4096
FLUSH = 100_000
SEED = 20_011


def counted(docs: DataFrame) -> DataFrame:
    """``word, c``: how often each token occurs in ``docs``; every text adds one end."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in chunks(batches, limit=1 << 20):
            for text in raw(batch.column("text")):
                counts.update(text.lower().split())
            counts[END] += batch.num_rows
            if len(counts) > FLUSH:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """The most frequent tokens with their counts; the first ``classes - 1`` are classes of their own, from 1.

    Class 0 stands for every other token, which follows its class by its smoothed count.
    """

    place: dict[bytes, int]
    counts: np.ndarray
    classes: int
    tokens: int
    distinct: int

    @property
    def end(self) -> int:
        return self.place[END] + 1

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    @property
    def other_total(self) -> float:
        own = self.counts[: self.classes - 1]
        return self.tokens - int(own.sum()) + 0.5 * (self.distinct - len(own) + 1)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Place of each token in the list, -1 if it has none, and the end."""
        return np.append(np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words)), self.place[END])

    def classed(self, ids: np.ndarray) -> np.ndarray:
        return np.where((ids >= 0) & (ids < self.classes - 1), ids + 1, 0).astype(np.uint16)


def lexicon(counts: DataFrame, listed: int = LISTED, classes: int = CLASSES) -> Lexicon:
    """The end first, then the most frequent words of at most ``LISTED_BYTES`` bytes: a bounded list.

    A histogram over logarithms of the counts gives the smallest count of which all words fit, so the driver never gets more
    than the list, whatever the number of tasks.
    """
    tokens, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    step = F.floor(F.log2("c") * 16).cast("int")
    short = counts.filter((F.length("word") <= LISTED_BYTES) & (F.col("word") != F.lit(END))).withColumn("step", step)
    have, least = 0, None
    for at, n in sorted(((r[0], r[1]) for r in short.groupBy("step").count().collect()), reverse=True):
        have += n
        if have > listed - 1:
            break
        least = at
    found = short.filter(F.col("step") >= least).select("word", "c").collect() if least is not None else []
    rows = sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda r: (-r[1], r[0]))
    ends = counts.filter(F.col("word") == F.lit(END)).select("c").first()
    rows = [(END, ends[0] if ends else 0), *rows]
    classes = min(classes, len(rows) + 1)
    return Lexicon({w: n for n, (w, _) in enumerate(rows)}, np.array([c for _, c in rows], np.int64), classes, int(tokens or 0), int(distinct))


def contexts(classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; a text starts after ends."""
    before = np.concatenate((np.array([end, end], np.uint16), classes))
    return before[1:-1], before[:-2]


class Model:
    """p(w | a, b) is proportional to exp(h q_w + bias_w), h = near * r_a + far * r_b."""

    def __init__(self, prior: np.ndarray, width: int = WIDTH, seed: int = SEED):
        m, rng = len(prior), np.random.default_rng(seed)
        self.context = (rng.standard_normal((m, width)) / np.sqrt(width)).astype(np.float32)
        self.target = np.zeros((m, width), np.float32)
        self.near, self.far = np.ones(width, np.float32), np.full(width, 0.5, np.float32)
        self.bias = np.log(prior).astype(np.float32)
        self.prior = prior

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for p in self.parts():
            p[...] = values[at : at + p.size].reshape(p.shape)
            at += p.size

    def train(self, stream: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], rate: float, seed: int) -> int:
        """One pass of noise-contrastive estimation over batches of (near, far, word); returns the tokens seen."""
        rng, m, seen = np.random.default_rng(seed), len(self.prior), 0
        cumulative, log_noise = np.cumsum(self.prior), np.log(NOISE * self.prior).astype(np.float32)
        sums = [np.full(p.shape, 1e-2, np.float32) for p in self.parts()]

        def move(n: int, gradient: np.ndarray, rows=None) -> None:
            value, total = self.parts()[n], sums[n]
            if rows is None:
                total += gradient**2
                value += rate * gradient / np.sqrt(total)
            else:
                total[rows] += gradient**2
                value[rows] += rate * gradient / np.sqrt(total[rows])

        def by_row(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first].astype(np.int64), np.add.reduceat(values[order], first, axis=0)

        for near, far, word in stream:
            n = len(word)
            seen += n
            a, b = self.context[near], self.context[far]
            h = a * self.near + b * self.far
            noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE) * cumulative[-1]), m - 1)
            q, qn = self.target[word], self.target[noise]
            true = np.einsum("nd,nd->n", h, q) + self.bias[word] - log_noise[word]
            false = h @ qn.T + self.bias[noise] - log_noise[noise]
            g = 1 / (1 + np.exp(np.clip(true, -30, 30)))
            gn = -1 / (1 + np.exp(np.clip(-false, -30, 30)))
            dh = (g[:, None] * q + gn @ qn) / n
            rows, dq = by_row(word, np.concatenate((g[:, None] * h, g[:, None]), axis=1) / n)
            nrows, dn = by_row(noise, np.concatenate((gn.T @ h, gn.sum(axis=0)[:, None]), axis=1) / n)
            da = by_row(np.concatenate((near, far)), np.concatenate((dh * self.near, dh * self.far)))
            move(2, (dh * a).sum(axis=0)), move(3, (dh * b).sum(axis=0))
            move(1, dq[:, :-1], rows), move(4, dq[:, -1], rows)
            move(1, dn[:, :-1], nrows), move(4, dn[:, -1], nrows)
            move(0, da[1], da[0])
        return seen

    def normalisers(self) -> np.ndarray:
        """Log of the sum over all words, for every pair of context classes (far, near)."""
        m = len(self.prior)
        out, base = np.empty((m, m), np.float32), self.context * self.near
        for b in range(m):
            scores = (base + self.context[b] * self.far) @ self.target.T + self.bias
            top = scores.max(axis=1)
            out[b] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return out

    def log_probabilities(self, near: np.ndarray, far: np.ndarray, word: np.ndarray, normalisers: np.ndarray) -> np.ndarray:
        h = self.context[near] * self.near + self.context[far] * self.far
        return (np.einsum("nd,nd->n", h, self.target[word]) + self.bias[word] - normalisers[far, near]).astype(np.float64)


def _batched(batches: Iterator[pa.RecordBatch], words: Lexicon) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All token positions of all texts, in batches."""
    for batch in chunks(batches, limit=1 << 20):
        parts = []
        for text in raw(batch.column("text")):
            classes = words.classed(words.ids(text.lower().split()))
            parts.append((*contexts(classes, words.end), classes))
        near, far, word = (np.concatenate(p) for p in zip(*parts))
        for at in range(0, len(word), BATCH):
            yield near[at : at + BATCH], far[at : at + BATCH], word[at : at + BATCH]


def trained(docs: DataFrame, words: Lexicon, rounds: int = 1, rate: float = 0.1) -> Model:
    """Rounds of training in every task over all its texts from common parameters, then the mean of the tasks'
    parameters by their number of tokens. The sums are grouped by parameter, so they follow the number of
    tasks; the driver gets one value for each parameter."""
    own = words.counts[: words.classes - 1]
    prior = np.concatenate(([max(0, words.tokens - int(own.sum()))], own)) + 0.5
    model = Model(prior / prior.sum())
    rows = docs.select(F.col("text").cast("string").alias("text"))
    for turn in range(rounds if words.tokens else 0):
        sent = rows.sparkSession.sparkContext.broadcast((words, model))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, start = sent.value
            own = Model(start.prior)
            own.load(start.flat())
            seen = own.train(_batched(batches, words), rate / (1 + turn), SEED + TaskContext.get().partitionId())
            if seen:
                values = own.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int64)), pa.array(values * seen), pa.array(np.full(len(values), seen, np.float64))], ["place", "total", "seen"])

        sums = rows.mapInArrow(run, "place long, total double, seen double").groupBy("place").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen")).toArrow()
        values = model.flat().astype(np.float64)
        values[sums.column("place").to_numpy()] = sums.column("total").to_numpy() / sums.column("seen").to_numpy()
        model.load(values)
    return model


def scored(docs: DataFrame, held_out: int = 1, listed: int = LISTED, classes: int = CLASSES, rounds: int = 1) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row for each row of ``docs``.

    Tokens are the A-Z lower-cased words of a text and one end; a null text is empty and has only its
    end. The model learns from the rows outside the held-out fold; a row without id is in no fold and isn't learned from.
    base_score: sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens. score: log10 probability of the
    text by the model: the class of each token given the two before it, normalised over all classes, and within
    the class of other tokens the smoothed share of the token. n_known: tokens that the training texts
    have. Only ``doc_id`` and ``text`` are read. Repeated rows count and are scored each by itself; an empty table gives an empty
    one, and with nothing to learn from the base is 0 for every text.

    Counts cover all training texts. The most frequent tokens, a bounded list, go to the tasks; so the
    tokens of a text that are left to join with the counts are rare ones, and none of them is a hot key.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = rows.filter(fold() != held_out)
    counts = stored(counted(training), "counts")
    words = lexicon(counts, listed, classes)
    model = trained(training, words, rounds)
    sent = rows.sparkSession.sparkContext.broadcast((words, model, model.normalisers()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model, normalisers = sent.value
        logs = np.log10(words.counts + 0.5)
        base_total, other_total, known = np.log10(words.base_total), np.log10(words.other_total), words.counts > 0
        number = TaskContext.get().partitionId() << 33
        for batch in chunks(batches, limit=1 << 20):
            texts, ids, rare = [t.lower().split() for t in raw(batch.column("text"))], [], []
            for tokens in texts:
                found = words.ids(tokens)
                ids.append(found)
                rare.append(list(Counter([tokens[i] for i in np.flatnonzero(found < 0).tolist()]).items()))
            starts = np.cumsum([0] + [len(i) for i in ids[:-1]])
            parts = [(*contexts(c, words.end), c) for c in map(words.classed, ids)]
            near, far, word = (np.concatenate(p) for p in zip(*parts))
            flat = np.concatenate(ids)
            own = np.where(flat >= 0, logs[flat], 0.0)
            score = model.log_probabilities(near, far, word, normalisers) / np.log(10) + np.where(word == 0, own - other_total, 0.0)
            columns = [
                pa.array(np.arange(len(ids)) + number), batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()),
                pa.array(np.add.reduceat(np.where(flat >= 0, known[flat], 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(own - base_total, starts)), pa.array(np.add.reduceat(score, starts)),
                pa.array([[{"word": w, "n": n} for w, n in r] for r in rare], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))]
            number += len(ids)
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_tokens", "n_listed", "base_listed", "score_listed", "rare"])

    schema = "row long, doc_id long, n_tokens long, n_listed long, base_listed double, score_listed double, rare array<struct<word:binary,n:long>>"
    parts = stored(rows.mapInArrow(run, schema), "scores")
    rare = parts.select("row", F.inline("rare")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rest = rare.groupBy("row").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_rare"), F.sum(F.col("n") * F.log10(c + 0.5)).alias("log_rare"))
    joined = parts.drop("rare").join(rest, "row", "left").withColumn("log_rare", F.coalesce("log_rare", F.lit(0.0)))
    return joined.select(
        "doc_id", F.coalesce(fold() == held_out, F.lit(False)).alias("held_out"), "n_tokens", (F.col("n_listed") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), (F.col("base_listed") + F.col("log_rare")).alias("base_score"), (F.col("score_listed") + F.col("log_rare")).alias("score"))
