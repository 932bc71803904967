"""Benchmark passages in documents: one FM-index per shard of documents, searched backward."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from punctum.llm.common import chunks, free_prefix, raw, stored

#: Words of an A-Z lower-cased text: digits, a-z and everything outside ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: The same words by splitting: A-Z to lower case, what is in no word to a space.
SPLIT = bytes(c if WORD.match(bytes([c])) else 32 for c in bytes(range(256)).lower())
SHARD_BYTES = 8 << 20
PASS_BYTES = 16 << 20


class WaveletTree:
    """Counts of a symbol before a position, level by level over the bits of the symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        rest = symbols
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (rest >> bit) & 1
            before = np.zeros(len(rest) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(rest) - int(before[-1])))
            rest = np.concatenate((rest[ones == 0], rest[ones == 1]))

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        first = np.zeros_like(position)
        for bit, before, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            a, b = before[position], before[first]
            position = np.where(one, zeros + a, position - a)
            first = np.where(one, zeros + b, first - b)
        return position - first


class FMIndex:
    """Index over ``tokens``: word numbers from 1, every run of words closed by a 0."""

    def __init__(self, tokens: np.ndarray, sigma: int, sample: int = 16):
        order = self._suffixes(tokens)
        self.last = tokens[order - 1]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(tokens, minlength=sigma))))
        self.tree = WaveletTree(self.last, sigma)
        self.marked = (order % sample == 0) | (self.last == 0)
        self.slot = np.cumsum(self.marked) - 1
        self.sampled = order[self.marked]

    @staticmethod
    def _suffixes(tokens: np.ndarray) -> np.ndarray:
        """Suffix order by doubling. The zeros are all different, so a comparison ends with its run."""
        n, zeros = len(tokens), np.flatnonzero(tokens == 0)
        key = tokens.astype(np.int64) + len(zeros)
        key[zeros] = np.arange(len(zeros))
        reach = 1
        while True:
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
            if rank[order[-1]] == n - 1:
                return order
            after = np.zeros(n, np.int64)
            after[:-reach] = rank[reach:] + 1
            key, reach = rank * (n + 1) + after, 2 * reach

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of each phrase; ``phrases`` is padded with zeros at the front."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, phrases.shape[1] - 1 - step]
            low[live] = self.starts[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.starts[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Token positions of rows: step back to the next sampled suffix."""
        found, steps, at, row = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows
        while len(at):
            here = self.marked[row]
            found[at[here]] = self.sampled[self.slot[row[here]]] + steps
            at, row = at[~here], row[~here]
            symbol = self.last[row]
            row, steps = self.starts[symbol] + self.tree.rank(symbol, row), steps + 1
        return found


@dataclass
class Phrases:
    """Test phrases as word numbers, and which items each belongs to."""

    words: dict[bytes, int]
    phrases: np.ndarray
    lengths: np.ndarray
    item_from: np.ndarray
    item_of: np.ndarray
    ids: list[int]


def phrases_of(items: list[tuple[int | None, bytes]], window: int) -> Phrases:
    """Every ``window`` consecutive words of an item, or all words of a shorter one."""
    words: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[int]] = {}
    ids = sorted({i for i, _ in items if i is not None})
    place = {i: n for n, i in enumerate(ids)}
    for item, text in items:
        tokens = [words.setdefault(w, len(words) + 1) for w in text.translate(SPLIT).split()]
        for at in range(max(1, len(tokens) - window + 1) if tokens else 0):
            owner = owners.setdefault(tuple(tokens[at : at + window]), set())
            if item is not None:
                owner.add(place[item])
    phrases = np.zeros((len(owners), window), np.int64)
    for n, phrase in enumerate(owners):
        phrases[n, window - len(phrase) :] = phrase
    counts = np.array([len(o) for o in owners.values()], np.int64)
    flat = np.array([i for o in owners.values() for i in sorted(o)], np.int64)
    return Phrases(words, phrases, np.array([len(p) for p in owners], np.int64), np.concatenate(([0], np.cumsum(counts))).astype(np.int64), flat, ids)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``range(start, start + count)``."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


def shard_hits(texts: list[bytes], wanted: Phrases) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Per text: number of words, merged spans of hit words (end exclusive), items with occurring phrases.

    Only runs of words that all occur in some phrase, at least as long as the shortest phrase, enter the
    shard's index; no phrase can occur elsewhere.
    """
    get, parts, sizes, other, gap = wanted.words.get, [], [], repeat(0), np.zeros(1, np.int64)
    for text in texts:
        tokens = text.translate(SPLIT).split()
        sizes.append(len(tokens))
        parts += [np.fromiter(map(get, tokens, other), np.int64, len(tokens)), gap]
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[int]] = [[] for _ in texts]
    if len(wanted.lengths) and texts:
        stream = np.concatenate(parts)
        origin = np.concatenate(([0], np.cumsum(np.array(sizes) + 1)))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (stream > 0).astype(np.int8), [0]))))
        begin, end = edges[::2], edges[1::2]
        long = end - begin >= wanted.lengths.min()
        begin, end = begin[long], end[long]
        if len(begin):
            where = _ranges(begin, end - begin + 1)
            tokens = stream[where]
            index = FMIndex(tokens, len(wanted.words) + 1)
            low, high = index.search(wanted.phrases, wanted.lengths)
            phrase = np.repeat(np.arange(len(low)), high - low)
            at = index.locate(_ranges(low, high - low))
            cover = np.zeros(len(tokens) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + wanted.lengths[phrase], -1)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(cover) > 0).astype(np.int8)))))
            for a, b in zip(where[edges[::2]].tolist(), where[edges[1::2] - 1].tolist()):
                doc = int(np.searchsorted(origin, a, side="right")) - 1
                spans[doc].append((a - int(origin[doc]), b + 1 - int(origin[doc])))
            doc = np.searchsorted(origin, where[at], side="right") - 1
            pairs = np.unique(doc * len(low) + phrase)
            doc, phrase = pairs // len(low), pairs % len(low)
            counts = wanted.item_from[phrase + 1] - wanted.item_from[phrase]
            owned = np.unique(np.repeat(doc, counts) * max(1, len(wanted.ids)) + wanted.item_of[_ranges(wanted.item_from[phrase], counts)])
            for pair in owned.tolist():
                items[pair // len(wanted.ids)].append(wanted.ids[pair % len(wanted.ids)])
    return list(zip(sizes, spans, items))


def _passes(benchmark: DataFrame, pass_bytes: int) -> list[DataFrame]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    count = -(-total // pass_bytes)
    if count <= 1:
        return [rows]
    return [rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == n) for n in range(count)]


def _wanted(rows: DataFrame, window: int):
    return rows.sparkSession.sparkContext.broadcast(phrases_of([(r[0], bytes(r[1])) for r in rows.collect()], window))


HITS = "array<struct<start:int,end:int>>"
_HITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``doc_id, n_words, spans, items``, one row for each row of ``docs``.

    spans: merged runs of words (number from 0, end exclusive) inside any occurrence of ``window``
    consecutive words of an item, or of a whole shorter item; items: ids of the items with such
    occurrences, ascending, without null ids. Null and empty texts have no words; an item without words
    never occurs; an empty benchmark hits nothing. Only ``doc_id``, ``text`` and ``item_id``, ``text`` are read.

    Documents stay where they are read: a shard is a few MB of them, and the phrases are broadcast in
    passes of at most ``pass_bytes`` of benchmark text. With more than one pass, the spans of a document
    meet in one row afterwards.
    """

    def run_with(wanted):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, limit=SHARD_BYTES):
                sizes, spans, items = zip(*shard_hits(raw(batch.column("text")), wanted.value))
                pairs = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pairs, pa.array(items, pa.list_(pa.int64()))], ["doc_id", "text_key", "n_words", "spans", "items"])

        return run

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    passes = _passes(benchmark, pass_bytes)
    found = [rows.mapInArrow(run_with(_wanted(p, window)), f"doc_id long, text_key long, n_words long, spans {HITS}, items array<long>") for p in passes]
    if len(found) == 1:
        return found[0].drop("text_key")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    merged = every.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), (F.count("*") / len(found)).cast("int").alias("n"))
    joined = F.expr("""aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (a, s) -> CASE
        WHEN size(a) > 0 AND s.start <= element_at(a, -1).end THEN concat(slice(a, 1, size(a) - 1),
            array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end))))
        ELSE concat(a, array(s)) END)""")
    return merged.withColumn("spans", joined).withColumn("n", F.explode(F.sequence(F.lit(1), "n"))).drop("n", "text_key")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one, ascending."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans; what stands between a span's first and last word goes too."""
    places = [m.span() for m in WORD.finditer(text.lower())]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` with every hit word removed from ``text``, all columns kept; a document without any
    hit passes unchanged, one of which no word is left is dropped. Words that only meet after a cut are
    searched again, until none is hit. With more than one pass, a text is cut once by the spans of all, and
    all search the changed texts again: the result is that of a single pass."""
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in docs.schema])

    def run_with(wanted):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, limit=SHARD_BYTES):
                texts = raw(batch.column("text"))
                new, open_, cut_once = list(texts), list(range(len(texts))), set()
                while open_:
                    hits = [(n, s) for n, (_, s, _) in zip(open_, shard_hits([new[n] for n in open_], wanted.value)) if s]
                    for n, s in hits:
                        new[n] = cut(new[n], s)
                    open_ = [n for n, _ in hits]
                    cut_once.update(open_)
                place = batch.schema.get_field_index("text")
                column = pa.array([new[n].decode() if n in cut_once else old for n, old in enumerate(batch.column(place).to_pylist())], pa.string())
                keep = pa.array([n not in cut_once or bool(new[n].translate(SPLIT).strip()) for n in range(len(new))])
                yield batch.set_column(place, "text", column).filter(keep)

        return run

    passes = _passes(benchmark, pass_bytes)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    if len(passes) == 1:
        return docs.mapInArrow(run_with(_wanted(passes[0], window)), schema)
    name = free_prefix(docs.columns, "hits_")
    marked = T.StructType([*schema.fields, T.StructField(name, T._parse_datatype_string(HITS))])

    def search_with(wanted):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, limit=SHARD_BYTES):
                found = [[{"start": a, "end": b} for a, b in s] for _, s, _ in shard_hits(raw(batch.column("text")), wanted.value)]
                place = batch.schema.get_field_index(name)
                every = pa.array([old + new for old, new in zip(batch.column(place).to_pylist(), found)], _HITS)
                yield batch.set_column(place, name, every)

        return search

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=SHARD_BYTES):
            place, texts, keep = batch.schema.get_field_index("text"), [], []
            for text, hits in zip(batch.column(place).to_pylist(), batch.column(name).to_pylist()):
                if hits:
                    text = cut(text.encode(), merged([(h["start"], h["end"]) for h in hits])).decode()
                texts.append(text)
                keep.append(not hits or bool(text.encode().translate(SPLIT).strip()))
            yield batch.set_column(place, "text", pa.array(texts, pa.string())).filter(pa.array(keep, pa.bool_()))

    wanted, settled = [_wanted(rows, window) for rows in passes], []
    while True:
        docs = docs.withColumn(name, F.array().cast(HITS))
        for each in wanted:
            docs = docs.mapInArrow(search_with(each), marked)
        docs = stored(docs.mapInArrow(cut_all, marked), "decontaminated")
        settled.append(docs.filter(F.size(name) == 0).drop(name))
        docs = docs.filter(F.size(name) > 0).drop(name)
        if docs.isEmpty():
            return reduce(DataFrame.union, settled)
