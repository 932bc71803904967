"""SimHash fingerprints, links by pigeonring chains of segments, and classes of near duplicates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from punctum.llm.common import NO_ID, chunks, free_prefix, raw, release, stored
from punctum.llm.components import components

BITS = 64
SEED = 42
SLICE = 1 << 15
#: Bits of the parity of a set of shingles.
PARITY = 512
#: Nodes under one shingle beyond which they meet by finer classes of size and by place.
CROWD = 64
BANDS = 8


def majority(digests: Iterable[np.ndarray], number: int) -> int:
    """The 64 bits that are 1 in over half of ``number`` hashes, given as slices of their bytes."""
    counts = np.zeros(BITS, np.int64)
    for part in digests:
        counts += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > number).tobytes(), "big", signed=True)


def fingerprint(text: bytes, words: int, digest=xxhash.xxh64_digest) -> int:
    """64-bit SimHash of the ``words``-word shingles, repeats included; 0 without words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist()
    hashes = (b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + SLICE], ends[at : at + SLICE])]) for at in range(0, len(starts), SLICE))
    return majority((np.frombuffer(h, np.uint8) for h in hashes), len(starts))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, text_key, fingerprint`` for every row of ``docs``; ``text_key`` is a hash of the text.

    A-Z are lower-cased, words are runs without ASCII white space, fewer words than a shingle make one
    shingle, an empty or null text has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values = [fingerprint(t, words) for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(values, pa.int64())], ["doc_id", "text_key", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fingerprint long")


class Ring:
    """The segments of a fingerprint on a ring, and the budget of every chain of them."""

    def __init__(self, max_bits: int):
        if max_bits < 0 or max_bits % 2 or max_bits > 6:
            raise ValueError("max_bits must be 0, 2, 4 or 6")
        self.max_bits, self.segments = max_bits, 2 * max_bits + 1
        cuts = [BITS * i // self.segments for i in range(self.segments + 1)]
        self.masks = [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(self.segments)]
        self.exact = max(n for n in range(1, self.segments + 1) if self.budget(n) == 0)

    def budget(self, length: int) -> int:
        """Most differing bits that a chain of ``length`` segments may have: its share of the whole budget."""
        return length * self.max_bits // self.segments

    def mask(self, start: int, length: int) -> int:
        value = sum(self.masks[(start + j) % self.segments] for j in range(length))
        return value - (1 << BITS) if value >> (BITS - 1) else value

    def viable(self, difference: str, start: int) -> str:
        """SQL: every chain that begins at ``start`` keeps within its budget; its whole ring is the Hamming check."""
        return " AND ".join(f"bit_count(({difference}) & ({self.mask(start, n)}L)) <= {self.budget(n)}" for n in range(1, self.segments + 1))

    def first(self, difference: str) -> str:
        """SQL: the first viable start on the ring, null if there is none. Two fingerprints within the
        threshold have at least one, so a pair met at several starts counts at one of them."""
        return "CASE " + " ".join(f"WHEN {self.viable(difference, i)} THEN {i}" for i in range(self.segments)) + " END"

    def flips(self, start: int) -> list[int]:
        """Changes of up to half the threshold among the bits that a key at ``start`` doesn't fix."""
        fixed, found = self.mask(start, self.exact) % (1 << BITS), {0}
        for _ in range(self.max_bits // 2):
            found |= {v ^ (1 << b) for v in found for b in range(BITS) if not fixed >> b & 1}
        return sorted(v - (1 << BITS) if v >> (BITS - 1) else v for v in found)


def links(nodes: DataFrame, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """Links ``which, a, b`` between the distinct values of ``fingerprint`` of each ``which`` that join all within ``max_bits``.

    By the strong pigeonring principle, two fingerprints that differ in at most t of 64 bits have a
    segment on a ring of 2t+1 from which every chain of n segments differs in at most n*t/(2t+1) bits.
    So the first t segments of the chain agree: they are the key. Pairs that share a key are kept if
    the whole chain holds, at its first start only.

    Keys with more than ``bucket`` values take another exact way, without pairs: each value visits the
    points within t/2 flips of its free bits. Two values are within t exactly if they visit a common
    point, and all that visit one point are within t of each other, so one link each to the smallest
    is enough to join them.
    """
    ring = Ring(max_bits)
    masks = F.array(*[F.lit(ring.mask(i, ring.exact)).cast("long") for i in range(ring.segments)])
    keyed = nodes.select("which", "fingerprint", F.posexplode(masks).alias("start", "mask"))
    keyed = keyed.select("which", "fingerprint", "start", F.expr("fingerprint & mask").alias("key"))
    place = ["which", "start", "key"]
    shared = keyed.groupBy(place).agg(F.count("*").alias("n")).filter("n > 1")
    met = stored(keyed.join(shared, place), "keys")
    few = met.filter(F.col("n") <= bucket).drop("n")
    a, b = few.select(*place, F.col("fingerprint").alias("a")), few.select(*place, F.col("fingerprint").alias("b"))
    near = a.join(b, place).filter("a < b").filter(F.expr(f"start = {ring.first('a ^ b')}")).select("which", "a", "b")
    many = met.filter(F.col("n") > bucket)
    flips = F.element_at(F.array(*[F.array(*[F.lit(v).cast("long") for v in ring.flips(i)]) for i in range(ring.segments)]), F.col("start") + 1)
    points = many.select("which", "start", F.col("fingerprint").alias("b"), F.explode(flips).alias("flip")).selectExpr("which", "start", "b", "b ^ flip AS point")
    place = ["which", "start", "point"]
    least = points.groupBy(place).agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    stars = points.join(least, place).filter("a <> b").select("which", "a", "b").distinct()
    return near.union(stars)


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """``doc_id, text_key, fingerprint, component_id``, one row for each row of ``docs``.

    component_id is the smallest doc_id among the documents reachable over links, the document itself
    included; null only if none of them has an id. Equal fingerprints are one node whatever their
    number, so copies never become pairs. Texts without words have fingerprint 0 and link like any other.
    Only ``doc_id`` and ``text`` are read. An empty table gives an empty table.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select(F.lit(0).alias("which"), "fingerprint"), max_bits, bucket))
    joined = nodes.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    classes = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    member = stored(joined.join(classes, "root").select("fingerprint", "component_id"), "classes")
    return prints.join(member, "fingerprint").select("doc_id", "text_key", "fingerprint", "component_id")


def hashed_shingles(text: bytes, words: int) -> np.ndarray:
    """The distinct hashed shingles of a text, ascending; fewer words than a shingle make one, none without words."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.int64)
    joined, k = b" ".join(tokens), min(words, len(tokens))
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - k + 1].tolist()
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :].tolist())]), np.int64))


def set_fingerprint(shingles: np.ndarray) -> int:
    """64-bit SimHash of a set of hashed shingles; 0 without any."""
    return majority((shingles[at : at + SLICE].view(np.uint8) for at in range(0, len(shingles), SLICE)), len(shingles))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))


def frequent(docs: DataFrame, words: int, part: int = 16, least: int = 4, most: int = 1 << 24) -> np.ndarray:
    """A Bloom filter, as 64-bit words, of the shingles met ``least`` times or more in one of ``part`` texts.

    It only orders shingles for ``prefixes``: whichever come last, false positives too, no pair is lost. Counts and bits are
    made in Spark. Bits follow the number of shingles, 16 to 32 each; if more than ``most`` are frequent, the least count
    rises, so the filter never exceeds 32 MB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([hashed_shingles(t, words) for t in raw(batch.column("text"))]))], ["shingle"])

    some = _texts(docs).filter(F.pmod("text_key", F.lit(part)) == 0).select("text").mapInArrow(run, "shingle long")
    counted = some.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    counted = stored(counted.select("shingle", F.floor(F.log2("n") * 4).cast("int").alias("level")), "frequent")
    number, lowest = 0, None
    for level, n in sorted(map(tuple, counted.groupBy("level").count().collect()), reverse=True):
        if number + n > most:
            break
        number, lowest = number + n, level
    size = max(64, 1 << (16 * number - 1).bit_length()) if number else 64
    bits = np.zeros(size // 64, np.int64)
    if lowest is not None:
        places = F.array(F.pmod("shingle", F.lit(size)), F.pmod(F.shiftrightunsigned("shingle", 32), F.lit(size)))
        at = counted.filter(F.col("level") >= lowest).select(F.explode(places).alias("place"))
        cells = at.groupBy(F.expr("place div 64").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits")).toArrow()
        bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    release(counted)
    return bits.view(np.uint64)


def listed(shingles: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the shingles the filter of ``frequent`` holds; a few others may seem to be held."""
    values, top, low = shingles.view(np.uint64), np.uint64(64 * len(bits) - 1), np.uint64(63)
    found = np.ones(len(values), bool)
    for place in (values & top, values >> np.uint64(32) & top):
        found &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & low) & np.uint64(1)).astype(bool)
    return found


def prefixes(shingles: np.ndarray, similarity: float, bits: np.ndarray) -> tuple[np.ndarray, int]:
    """The first shingles of a set in an order that all sets share, the frequent ones at the end, else by value; and how many of them lead.

    Of two sets with the similarity the smaller shares ``2 s / (1 + s)`` of its shingles at least and the larger ``s``. So their first
    common shingle in the order is among those of the smaller that lead, and among all that are given of the larger: each
    leaves out one less than it must share from the end of the order.
    """
    size = len(shingles)
    late = listed(shingles, bits)
    shingles = np.concatenate((shingles[~late], shingles[late]))
    first = lambda share: min(size, size - int(np.ceil(share * size - 1e-9)) + 1)
    return shingles[: first(similarity)], first(2 * similarity / (1 + similarity))


def parity(shingles: np.ndarray, bits: int = PARITY) -> np.ndarray:
    """``bits`` bits: whether an odd number of the shingles falls on each. Two sets differ in as many shingles at least as in bits."""
    at = (shingles.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1).view(np.int64)


def wide(shingles: np.ndarray) -> np.ndarray:
    """The parity with as many bits as shingles at least, a power of two; its halves by xor are that of half the bits."""
    return parity(shingles, max(PARITY, 1 << max(0, len(shingles) - 1).bit_length()))


def sketches(docs: DataFrame, words: int, similarity: float, bits) -> DataFrame:
    """``doc_id, text_key, node, fingerprint, size, keys, leading, own, parity, wide`` for every row; a null id is ``NO_ID``, texts of equal shingles have one node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = [hashed_shingles(t, words) for t in raw(batch.column("text"))]
            nodes = [int.from_bytes(sha256(s.tobytes()).digest()[:8], "big", signed=True) for s in sets]
            firsts = [prefixes(s, similarity, bits.value) for s in sets]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.int64()), pa.array(list(map(set_fingerprint, sets)), pa.int64()), pa.array(list(map(len, sets)), pa.int32()),
                pa.array([keys for keys, _ in firsts], longs), pa.array([n for _, n in firsts], pa.int32()), pa.array([int((~listed(s, bits.value)).sum()) for s in sets], pa.int32()),
                pa.array(list(map(parity, sets)), longs), pa.array(list(map(wide, sets)), longs)],
                ["doc_id", "text_key", "node", "fingerprint", "size", "keys", "leading", "own", "parity", "wide"])

    return _texts(docs).mapInArrow(run, "doc_id long, text_key long, node long, fingerprint long, size int, keys array<long>, leading int, own int, parity array<long>, wide array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, shingles``: the distinct hashed shingles of the texts of ``wanted (node, doc_id, text_key)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = [hashed_shingles(t, words) for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    met = _texts(docs).join(wanted, ["doc_id", "text_key"]).select("node", "text")
    return met.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _possible(similarity: float, a: str, b: str) -> str:
    """SQL: sizes and parities allow the similarity; false only for pairs below it."""
    sizes = f"({a}.size + {b}.size)"
    off = " + ".join(f"bit_count({a}.parity[{n}] ^ {b}.parity[{n}])" for n in range(PARITY // BITS))
    return f"least({a}.size, {b}.size) >= {similarity} * greatest({a}.size, {b}.size) - 1e-9 AND {off} <= {(1 - similarity) / (1 + similarity)} * {sizes} + 1e-9"


def _possible_wide(similarity: float, a: str, b: str) -> str:
    """SQL: as ``_possible``, by the wide parities; the longer of two is folded if it has twice the bits."""
    least = f"least(size({a}.wide), size({b}.wide))"
    bits = lambda c: f"(CASE WHEN size({c}.wide) > {least} THEN {c}.wide[i] ^ {c}.wide[i + {least}] ELSE {c}.wide[i] END)"
    off = f"aggregate(sequence(0, {least} - 1), 0, (n, i) -> n + bit_count({bits(a)} ^ {bits(b)}))"
    return f"greatest(size({a}.wide), size({b}.wide)) > 2 * {least} OR {off} <= {(1 - similarity) / (1 + similarity)} * ({a}.size + {b}.size) + 1e-9"


def _similar(docs: DataFrame, nodes: DataFrame, close: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs of ``close (a, b)`` that have the similarity, by their shingles."""
    side = lambda c: nodes.select(F.col("node").alias(c), "size", "wide").alias(c)
    close = stored(close.join(side("a"), "a").join(side("b"), "b").filter(_possible_wide(similarity, "a", "b")).select("a", "b"), "close")
    wanted = close.select(F.col("a").alias("node")).union(close.select("b")).distinct().join(nodes.select("node", "least.*"), "node")
    wanted = stored(wanted, "wanted")
    sets = stored(shingle_sets(docs, wanted, words), "shingles")
    release(wanted)
    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    common, every = F.size(F.array_intersect("set_a", "set_b")), F.size("set_a") + F.size("set_b")
    both = close.join(of("a"), "a").join(of("b"), "b")
    found = stored(both.filter(common * (1 + similarity) >= every * similarity - 1e-9).select("a", "b"), "similar")
    release(sets)
    release(close)
    return found


def _by_fingerprint(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a, b`` of nodes that the links of their fingerprints join: of equal fingerprints each with the one with fewest shingles that are
    not frequent, and these with each other as ``links`` has them."""
    prints = nodes.groupBy("fingerprint").agg(F.min(F.struct("own", "node")).alias("least"))
    prints = stored(prints.select("fingerprint", F.col("least.node").alias("first")), "prints")
    equal = nodes.select("node", "fingerprint").join(prints, "fingerprint").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    of = lambda c: prints.select(F.col("fingerprint").alias(c), F.col("first").alias(f"of_{c}"))
    linked = links(prints.select(F.lit(0).alias("which"), "fingerprint"), max_bits).join(of("a"), "a").join(of("b"), "b")
    return equal.union(linked.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))


def _across(met: DataFrame, light: DataFrame, roots: DataFrame, similarity: float, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a, b`` of ``met (key, node, at, leads)`` that share a key, belong to different ``roots`` and may have the similarity.

    Under a key a node that leads with it meets the nodes of its own or the next class of sizes, which has all that are not
    smaller and near in size. The largest group under a key only meets the others. Of the key that comes first in both nodes of a pair,
    neither place leaves fewer shingles than the pair must share: so a place allows sizes of the other node up to a largest one, and the
    less the two differ in size, the nearer to the front both are.

    Under a key of more than ``crowd`` nodes that is part of what they are joined by: classes are finer, and a node is there once for each
    number of classes between it and the other that its place allows. The copies of a text that are too far from it to join the largest
    group have more shingles of their own in front than a place may have, so they do not meet that group though all share the key.
    """
    labelled = met.join(roots, "node", "left").select("key", "node", "at", "leads", F.coalesce("root", "node").alias("root"))
    groups = labelled.groupBy("key", "root").agg(F.count("*").alias("n"), F.max("leads").alias("leads")).groupBy("key")
    groups = groups.agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("groups"), F.max("leads").alias("leads"))
    several = groups.filter("groups > 1 AND leads").select("key", F.col("main.root").alias("main"), F.expr(f"n > {crowd}").alias("crowded"))
    step, part = float(np.log(1 / similarity) + 1e-6), similarity / (1 + similarity)
    class_of = lambda size, step: F.expr(f"CAST(floor(ln({size}) / {step}) AS INT)")
    sized = labelled.join(several, "key").join(light, "node").withColumn("reach", F.expr(f"greatest(1, (size - at) / {part} - size + 1e-6)"))
    sized = sized.withColumns({"class": class_of("size", step), "fine": class_of("size", step / BANDS), "beyond": class_of("reach", step / BANDS)})
    open_ = stored(sized.withColumn("beyond", F.expr("beyond - fine")), "open")
    # The classes where a node is as the smaller of a pair, and as the other; ``gap`` counts the classes between them.
    smaller = F.expr(f"CASE WHEN NOT crowded THEN array(struct(class AS of, 0 AS gap), struct(class + 1 AS of, 0 AS gap)) "
                     f"WHEN beyond >= 0 THEN transform(sequence(0, least(beyond, {BANDS})), g -> struct(fine + g AS of, g AS gap)) END")
    other = F.expr(f"CASE WHEN NOT crowded THEN array(struct(class AS of, 0 AS gap)) "
                   f"WHEN beyond >= -{BANDS} THEN transform(sequence(greatest(0, -beyond), {BANDS}), g -> struct(fine AS of, g AS gap)) END")
    placed = lambda rows, where: rows.withColumn("where", F.explode(where)).select("*", "where.*").drop("where")

    def meeting(a: DataFrame, b: DataFrame) -> DataFrame:
        allowed = "b.size <= a.reach AND a.size <= b.reach"
        apart = F.expr(f"a.key = b.key AND a.of = b.of AND a.gap = b.gap AND a.root <> b.root AND a.size <= b.size AND {allowed} AND {_possible(similarity, 'a', 'b')}")
        met = placed(a, smaller).alias("a").join(placed(b, other).alias("b"), apart)
        return met.select(F.greatest("a.node", "b.node").alias("a"), F.least("a.node", "b.node").alias("b"))

    leading = open_.filter("leads")
    pairs = meeting(leading.filter("root <> main"), open_).union(meeting(leading.filter("root = main"), open_.filter("root <> main")))
    found = stored(pairs.distinct(), "across")
    release(open_)
    return found


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, text_key, stays``, one row for each row of ``docs``: groups of texts that agree in ``similarity``
    of their distinct ``words``-word shingles, and the one row of each group that stays (smallest id, null ids last, then
    smallest text key; of wholly equal rows all are marked).

    The groups are those of all pairs, none is missed: texts with the similarity share a shingle of their prefixes, with which the
    smaller leads. A shingle with which no text leads joins none: so texts of one template that differ in more than a ninth, and
    have that first in the order, never meet. Texts of equal shingles are one node. First nodes are compared that the links of their SimHash
    fingerprints join (within 2 bits, by pigeonring chains; these alone would miss pairs), and each node with one of those under each shingle of
    its prefix, the one with fewest shingles that are not frequent (the least edited of many copies), which joins most copies in one comparison
    a text. What then still shares a shingle across
    groups is compared too, by classes of size; inside a group no more pairs are needed. Sizes and parities, for long texts of more bits, rule out pairs without a loss, the shingles decide.
    """
    bits = docs.sparkSession.sparkContext.broadcast(frequent(docs, words))
    full = stored(sketches(docs, words, similarity, bits), "sketches")
    firsts = [F.first(c).alias(c) for c in ("size", "parity", "wide", "keys", "leading", "own", "fingerprint")]
    nodes = stored(full.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("least"), *firsts), "nodes")
    rows = stored(full.select("doc_id", "text_key", "node"), "rows")
    release(full)
    # One shuffle; a window may spill, so a shingle of any number of texts needs no memory.
    of_key = Window.partitionBy("key")
    keyed = nodes.select("node", "leading", "own", F.posexplode("keys").alias("at", "key")).select("key", "node", "own", "at", F.expr("at < leading").alias("leads"))
    least = F.min(F.struct("own", "node")).over(of_key)["node"]
    met = keyed.select("*", least.alias("centre"), F.count("*").over(of_key).alias("n"), F.max("leads").over(of_key).alias("led"))
    met = stored(met.filter("n > 1 AND led").select("key", "node", "at", "leads", "centre"), "met")
    light = nodes.select("node", "size", "parity")
    side = lambda c: light.withColumnRenamed("node", c).alias(c)
    linked = stored(_by_fingerprint(nodes), "linked")
    pairs = met.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).union(linked).distinct()
    close = stored(pairs.join(side("a"), "a").join(side("b"), "b").filter(_possible(similarity, "a", "b")).select("a", "b"), "close")
    sure = _similar(docs, nodes, close, words, similarity)
    release(close)
    release(linked)
    roots = components(sure)
    across = _across(met.drop("centre"), light, roots, similarity)
    release(met)
    more = _similar(docs, nodes, across, words, similarity)
    release(across)
    if not more.isEmpty():
        roots = components(sure.union(more))
    grouped = nodes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    first = grouped.groupBy("root").agg(F.min("least").alias("first"))
    stays = stored(grouped.join(first, "root").filter("least = first").select("node", "first"), "stays")
    found = rows.join(stays, "node", "left")
    here = F.coalesce(F.struct("doc_id", "text_key") == F.col("first"), F.lit(False))
    return found.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "text_key", here.alias("stays"))


def deduplicated(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near copies, with all its columns."""
    stays = near_copies(docs, words, similarity).filter("stays").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    near_ = free_prefix(docs.columns, "near_")
    stays = stored(stays.select(*[F.col(c).alias(near_ + c) for c in stays.columns]), "kept")
    keys = [near_ + "kept_id", near_ + "kept_key"]
    rows = docs.withColumns({keys[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), keys[1]: F.xxhash64("text")})
    # The join and the removal of repeated rows share one shuffle.
    return rows.join(stays.withColumn(keys[0], F.coalesce(keys[0], F.lit(NO_ID))), keys, "left_semi").dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])
