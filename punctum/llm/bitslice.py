"""Exact highest inner products over a bit-sliced index of quantised vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

PASS_BYTES = 16 << 20
ROWS = 1 << 13
QUERIES = 64
BITS = 6


def quantised(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)``; rows without id, without vector, or with a null
    or non-finite component are left out."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    sound = F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return rows.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def matrix(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """One row per vector; missing components are 0."""
    sizes = np.asarray(pc.list_value_length(column))
    values = column.flatten().to_numpy()
    width = int(sizes.max(initial=0)) if width is None else width
    if not len(sizes) or sizes.min() == sizes.max() == width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, part in enumerate(np.split(values, np.cumsum(sizes)[:-1])):
        out[i, : min(width, len(part))] = part[:width]
    return out


def _add(columns: list[list[np.ndarray]], weight: int, bitmap: np.ndarray) -> None:
    """Add a bitmap at a weight: three of one weight become one there and a carry."""
    while len(columns) <= weight + 1:
        columns.append([])
    columns[weight].append(bitmap)
    while len(columns[weight]) == 3:
        a, b, c = columns[weight]
        half = a ^ b
        columns[weight] = [half ^ c]
        carry = (a & b) | (half & c)
        weight += 1
        if len(columns) <= weight + 1:
            columns.append([])
        columns[weight].append(carry)


def _finish(columns: list[list[np.ndarray]], zero: np.ndarray) -> list[np.ndarray]:
    """One bitmap per weight, least significant first."""
    weight = 0
    while weight < len(columns):
        if len(columns[weight]) == 2:
            a, b = columns[weight]
            columns[weight] = [a ^ b]
            _add(columns, weight + 1, a & b)
        weight += 1
    return [c[0] if c else zero for c in columns]


class Block:
    """Bit slices of up to ``ROWS`` vectors: for each component, a bitmap of rows per bit."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, width = vectors.shape
        self.low = vectors.min(axis=0) if n and width else np.zeros(width, np.int64)
        above = vectors - self.low
        self.shift = max(0, int(above.max(initial=0)).bit_length() - BITS)
        coarse = above >> self.shift
        rest = (above - (coarse << self.shift)) - ((1 << self.shift) - 1) / 2
        self.rest = float(np.sqrt((rest**2).sum(axis=1)).max(initial=0))
        self.norm = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
        words = -(-n // 64)
        padded = np.zeros((words * 64, width), np.uint8)
        padded[:n] = coarse
        self.slices = [[self._bitmap((padded[:, d] >> bit) & 1) for bit in range(int(padded[:, d].max(initial=0)).bit_length())] for d in range(width)]
        self.valid = self._bitmap((np.arange(words * 64) < n).astype(np.uint8))

    @staticmethod
    def _bitmap(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def coarse(self, queries: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Slices of the coarse scores (queries by row words), and how many units a true score may be off.

        A score is a constant of the query, plus the coarse sum in units, plus at most the Cauchy-Schwarz
        bound of what quantising left out. A negative component adds the complement of the slices.
        """
        shift = max(0, int(np.abs(queries).max(initial=0)).bit_length() - BITS)
        size = (np.abs(queries) + ((1 << shift) >> 1)) >> shift
        negative = queries < 0
        kept = np.where(negative, -size, size) << shift
        columns: list[list[np.ndarray]] = []
        full = np.uint64(2**64 - 1)
        for d, slices in enumerate(self.slices):
            if not slices:
                continue
            signs = np.where(negative[:, d], full, np.uint64(0))[:, None]
            signed = [s ^ signs for s in slices]
            for bit in range(int(size[:, d].max(initial=0)).bit_length()):
                chosen = np.where((size[:, d] >> bit) & 1 == 1, full, np.uint64(0))[:, None]
                for weight, s in enumerate(signed):
                    _add(columns, bit + weight, s & chosen)
        zero = np.zeros((len(queries), len(self.valid)), np.uint64)
        off = np.sqrt((kept.astype(np.float64) ** 2).sum(axis=1)) * self.rest + np.sqrt(((queries - kept).astype(np.float64) ** 2).sum(axis=1)) * self.norm
        return _finish(columns, zero), np.ceil(2 * off / 2.0 ** (shift + self.shift)).astype(np.int64) + 2

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and exact scores of each query's best rows here, its own id left out."""
        slices, off = self.coarse(queries)
        order = np.sort(self.ids)
        own = np.searchsorted(order, query_ids, "right") - np.searchsorted(order, query_ids, "left")
        wanted, equal = k + own, np.broadcast_to(self.valid, (len(queries), len(self.valid)))
        above, least = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for bit in range(len(slices) - 1, -1, -1):  # the wanted-th highest coarse score, from the most significant slice
            with_one = equal & slices[bit]
            count = np.bitwise_count(with_one).sum(axis=1, dtype=np.int64)
            one = above + count >= wanted
            least |= one.astype(np.int64) << bit
            above += np.where(one, 0, count)
            equal = np.where(one[:, None], with_one, equal & ~slices[bit])
        least = np.maximum(least - off, 0)
        higher, equal = np.zeros_like(equal), np.broadcast_to(self.valid, equal.shape)
        for bit in range(len(slices) - 1, -1, -1):  # rows at or above the boundary
            one = ((least >> bit) & 1 == 1)[:, None]
            with_one = equal & slices[bit]
            higher = np.where(one, higher, higher | with_one)
            equal = np.where(one, with_one, equal & ~slices[bit])
        chosen, found = higher | equal, []
        for q in range(len(queries)):
            rows = np.flatnonzero(np.unpackbits(chosen[q].view(np.uint8), bitorder="little"))
            rows = rows[self.ids[rows] != query_ids[q]]
            scores = self.vectors[rows] @ queries[q]
            best = np.lexsort((self.ids[rows], -scores))[:k]
            found.append((self.ids[rows[best]], scores[best]))
        return found


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    """Blocks of ``ROWS`` rows over the batches of a task."""
    ids, parts, have = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            ids.append(part.column("vec_id").to_numpy()), parts.append(matrix(part.column("v"), width))
            have += part.num_rows
            if have >= ROWS:
                yield Block(np.concatenate(ids), np.concatenate(parts))
                ids, parts, have = [], [], 0
    if have:
        yield Block(np.concatenate(ids), np.concatenate(parts))


def _searched(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query, query_id, vec_id, score``: the best rows of every task for each query of one pass."""
    table = asked.toArrow()
    ids = table.column("vec_id").to_numpy()
    vectors = matrix(pa.concat_arrays(table.column("v").chunks or [pa.array([], pa.list_(pa.int64()))]))
    sent = rows.sparkSession.sparkContext.broadcast((ids, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = sent.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        for block in _blocks(batches, vectors.shape[1]):
            for at in range(0, len(ids), QUERIES):
                for q, (rows, scores) in enumerate(block.top(ids[at : at + QUERIES], vectors[at : at + QUERIES], k), at):
                    rows, scores = np.concatenate((best[q][0], rows)), np.concatenate((best[q][1], scores))
                    order = np.lexsort((rows, -scores))[:k]
                    best[q] = rows[order], scores[order]
        sizes = [len(b[0]) for b in best]
        if sum(sizes):
            number = np.repeat(np.arange(len(ids)), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids[number]), pa.array(np.concatenate([b[0] for b in best])), pa.array(np.concatenate([b[1] for b in best]))], ["query", "query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query long, query_id long, vec_id long, score long")


def top_inner_products(rows: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding", scale: int = 256, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of highest integer inner product for every query row.

    Components are ``floor(scale * x)``. A row of the query's own id is no candidate; equal scores go to the
    smaller vec_id; fewer candidates give fewer rows. Rows whose vector or id is null, or that hold a null or
    non-finite component, take no part. Vectors of unequal length: missing components count as 0. Repeated
    rows are rows of their own, as candidates and as queries. An empty table, or one without queries, gives an empty one.
    Only ``vec_id`` and the vector are read.

    Every task cuts its rows into blocks of bit slices and adds, for a set of queries at a time, the
    slices of the leading bits with bitmap arithmetic. The boundary score is found from the most
    significant slice downward; rows that could still be among the best within the bound of what
    quantising left out are resolved exactly. Queries go to the tasks in passes of at most ``pass_bytes``; each
    task returns ``k`` rows a query. No row meets another in a join.
    """
    rows, asked = quantised(rows, vector, scale), quantised(queries, vector, scale)
    total = asked.agg(F.sum(F.size("v") + 2)).first()[0] or 0
    passes = max(1, -(-total * 8 // pass_bytes))
    found = None
    for n in range(passes):
        part = asked if passes == 1 else asked.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(passes)) == n)
        more = _searched(rows, part, k).withColumn("pass", F.lit(n))
        found = more if found is None else found.union(more)
    best = Window.partitionBy("pass", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
