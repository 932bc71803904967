"""Words inside long passages that also start earlier, found over difference-cover anchors."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import NO_ID, chunks, raw, release, stored

#: Difference covers by period: for any two residues some shift takes both into the cover (fixed values).
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
SPANS = "array<struct<start:int,end:int>>"


def joined(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words joined by one space, and where each begins and ends."""
    words = text.split()
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return b" ".join(words), np.concatenate(([0], ends[:-1] + 1))[: len(words)].astype(np.int64), ends


def anchor_positions(n: int, window: int, period: int) -> np.ndarray:
    """Positions of a text of ``n`` words where an anchor is hashed."""
    length = window - period + 1
    return np.flatnonzero(np.isin(np.arange(max(0, n - length + 1)) % period, COVERS[period])) if n >= window else np.empty(0, np.int64)


def _anchors(text: bytes, window: int, period: int) -> tuple[int, str, bytes, np.ndarray]:
    whole, begin, end = joined(text)
    at, length, digest = anchor_positions(len(begin), window, period), window - period + 1, xxhash.xxh64_digest
    hashes = b"".join([digest(whole[a:b]) for a, b in zip(begin[at].tolist(), end[at + length - 1].tolist())])
    return len(begin), whole, np.frombuffer(hashes, ">i8").astype(np.int64)


def scanned(docs: DataFrame, window: int, period: int) -> DataFrame:
    """One row per row, numbered: words, their digest, and the hashes at the cover positions in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in chunks(batches):
            counts, digests, keys, anchors, again = [], [], [], [], []
            for text in raw(batch.column("text")):
                n, whole, hashes = _anchors(text, window, period)
                sha = sha256(whole)
                counts.append(n), digests.append(sha.hexdigest()), keys.append(int.from_bytes(sha.digest()[:8], "big", signed=True))
                values, seen = np.unique(hashes, return_counts=True)
                anchors.append(hashes), again.append(values[seen > 1])
            arrays = [pa.array(counts, pa.int64()), pa.array(digests), pa.array(keys, pa.int64()), pa.array(anchors, pa.list_(pa.int64())), pa.array(again, pa.list_(pa.int64()))]
            row = pa.array(np.arange(batch.num_rows) + number)
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays([row, batch.column("doc_id"), batch.column("text_key"), *arrays], ["row", "doc_id", "text_key", "n_words", "words_sha", "words_key", "anchors", "again"])

    schema = "row long, doc_id long, text_key long, n_words long, words_sha string, words_key long, anchors array<long>, again array<long>"
    return keyed(docs).mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))


def candidate_starts(n: int, flagged: np.ndarray, window: int, period: int) -> np.ndarray:
    """Starts of the windows that hold a flagged anchor whole."""
    length = window - period + 1
    edge = np.zeros(max(0, n - window + 1) + 1, np.int64)
    np.add.at(edge, np.clip(flagged + length - window, 0, len(edge) - 1), 1)
    np.add.at(edge, np.clip(flagged + 1, 0, len(edge) - 1), -1)
    return np.flatnonzero(np.cumsum(edge)[:-1] > 0)


def _extended(window: int, period: int):
    """Windows around flagged anchors: 128-bit hash of the first start of each sequence in its
    document; of later starts only the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in chunks(batches):
            high, low, first, later = [], [], [], []
            for text, flagged in zip(raw(batch.column("text")), batch.column("flagged")):
                whole, begin, end = joined(text)
                place = anchor_positions(len(begin), window, period)[np.unique(flagged.values.to_numpy())]
                starts = candidate_starts(len(begin), place, window, period)
                hashes = np.frombuffer(b"".join([digest(whole[a:b]) for a, b in zip(begin[starts].tolist(), end[starts + window - 1].tolist())]), ">i8").reshape(-1, 2).astype(np.int64)
                one = np.unique(hashes, axis=0, return_index=True)[1] if len(hashes) else np.empty(0, np.int64)
                one.sort()
                rest = np.ones(len(starts), bool)
                rest[one] = False
                high.append(hashes[one, 0]), low.append(hashes[one, 1]), first.append(starts[one].astype(np.int32)), later.append(starts[rest].astype(np.int32))
            longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            names = ["row", "doc_id", "text"]
            arrays = [pa.array(high, longs), pa.array(low, longs), pa.array(first, ints), pa.array(later, ints)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *arrays], [*names, "high", "low", "first", "later"])

    return run


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            spans, removed, digests = [], [], []
            for text, starts in zip(raw(batch.column("text")), batch.column("starts")):
                words = text.split()
                cover = np.zeros(len(words) + 1, np.int64)
                at = np.unique(starts.values.to_numpy())
                cover[at] += 1
                cover[at + window] -= 1
                gone = np.cumsum(cover) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8))))).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                removed.append(int(gone.sum()))
                digests.append(sha256(b" ".join([w for w, g in zip(words, gone.tolist()) if not g])).hexdigest())
            pairs = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pairs, pa.array(removed, pa.int64()), pa.array(digests)], ["row", "spans", "n_removed", "kept_sha256"])

    return run


def repeated_passages(docs: DataFrame, window: int = 20, period: int = 13) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_sha256``, one row for each row of ``docs``.

    A word goes if it lies in ``window`` consecutive words that also start in a document of smaller
    doc_id, or earlier in its own. spans: the removed words (number from 0, end exclusive);
    kept_sha256: of the kept words joined by one space. Windows are judged on the input. Rows of one
    doc_id don't remove each other's words; a null doc_id comes after all others and stays null. Null,
    empty and short texts keep all their words. Only ``doc_id`` and ``text`` are read.

    Anchors: any two equal windows hold an equal sub-window of ``window - period + 1`` words at positions
    that both lie in the difference cover modulo ``period``. So only cover positions are hashed; an anchor
    seen in one text only is dropped; around the others the window is extended to its full length and
    hashed again with 128 bits, and the smallest doc_id is taken per hash. Documents of equal words are one
    text for all of this: all but those of the smallest id lose every word.
    """
    if period not in COVERS or window - period < 1:
        raise ValueError(f"period must be one of {sorted(COVERS)} and below window")
    scan = stored(scanned(docs, window, period), "anchors")
    rows = stored(scan.select("row", "doc_id", "text_key", "n_words", "words_sha"), "rows")
    first = F.min(F.struct("doc_id", "text_key", "row")).alias("least")
    texts = stored(rows.groupBy("words_sha").agg(first).select("words_sha", "least.*"), "texts")
    once = scan.select("words_key", F.explode("anchors").alias("hash"))
    twice = scan.select((F.col("words_key") + 1).alias("words_key"), F.explode("again").alias("hash"))
    ends = once.union(twice).groupBy("hash").agg(F.min("words_key").alias("low"), F.max("words_key").alias("high"))
    shared = stored(ends.filter("low <> high").select("hash"), "shared")
    every = scan.select("row", F.posexplode("anchors").alias("place", "hash"))
    flagged = every.join(shared, "hash", "left_semi").groupBy("row").agg(F.collect_set("place").alias("flagged"))
    flagged = stored(flagged.join(texts.drop("words_sha"), "row"), "flagged")
    release(scan), release(shared)
    wide = keyed(docs).join(flagged, ["doc_id", "text_key"]).select("row", "doc_id", "text", "flagged")
    windows = stored(wide.mapInArrow(_extended(window, period), "row long, doc_id long, text string, high array<long>, low array<long>, first array<int>, later array<int>"), "windows")
    release(flagged)
    one = windows.select("row", "doc_id", F.explode(F.arrays_zip("high", "low", "first")).alias("w")).select("row", "doc_id", "w.*")
    earliest = one.groupBy("high", "low").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
    earliest = stored(earliest.filter("earliest < latest").drop("latest"), "earliest")
    gone = one.join(earliest, ["high", "low"]).filter("earliest < doc_id").select("row", F.col("first").alias("at"))
    gone = gone.union(windows.select("row", F.explode("later").alias("at")))
    starts = stored(gone.groupBy("row").agg(F.collect_set("at").alias("starts")), "starts")
    release(earliest)
    kept = windows.select("row", "text").join(starts, "row").mapInArrow(_kept(window), f"row long, spans {SPANS}, n_removed long, kept_sha256 string")
    kept = stored(kept.dropDuplicates(["row"]), "kept")  # repeated rows of one id share their row
    release(windows), release(starts)
    own = rows.select("words_sha", F.col("doc_id").alias("own_id"), F.col("n_words").alias("n"))
    found = own.join(texts.select("words_sha", "doc_id", "row"), "words_sha").join(kept, "row", "left")
    copy, none = (F.col("own_id") > F.col("doc_id")) & (F.col("n") >= window), F.sha2(F.lit("").cast("binary"), 256)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end")))
    return found.select(
        F.when(F.col("own_id") != NO_ID, F.col("own_id")).alias("doc_id"), F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, whole).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(copy, none).otherwise(F.coalesce("kept_sha256", "words_sha")).alias("kept_sha256"))
