"""The prefix trie of conversations, with totals of subtrees by time-forward processing in shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from punctum.llm.common import stored
from punctum.llm.spilling import SpillingQueue, placed

GROUP, HEADS = 5, 9
#: A shard of the first round is a subtree of at most so many conversations; every round's bound is this times the last.
MEMBERS = 1024
#: Conversations that end at one node are joined to pieces of so many ids before they meet.
PIECE = 4096
SALTS = 32
WORDS = ("w0", "w1", "w2", "w3")
TOTALS = "key binary, parent binary, conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, top boolean"


KINDS = {"binary": pa.binary(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
ENDS, PIECES = "key binary, ends_sha256 string", "key binary, start bigint, ids string"


def _batch(rows: list[tuple], shape: str) -> pa.RecordBatch:
    """A batch of rows in columns as ``shape`` says."""
    names, kinds = zip(*(field.split() for field in shape.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[kind]) for c, kind in zip(columns, kinds)], names=list(names))


def _words(digest: Column, depth: Column) -> list[Column]:
    """Four words of 32 bits of a turn at its depth."""
    depth = depth.cast("long")
    pair = F.xxhash64(digest, depth), F.xxhash64(depth, F.lit("trie"), digest)
    return [word.alias(name) for name, word in zip(WORDS, (w for h in pair for w in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))))]


def _key(depth: Column, words: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[w.cast("string") for w in words]).cast("binary")))


def _root() -> Column:
    return _key(F.lit(0), [F.lit(0)] * len(WORDS))


def turns_of(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, n_bytes`` of each turn; null role and text are empty, rows without conv_id form no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    return rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, digest, n_bytes`` of the rebuilt conversations, and ``conv_id, length`` of all, those without turns too.

    The first h turns come from conversation c - c % 5 (all if it has fewer, none if it is absent), then the own turns after
    the first h; h is crc32 of the decimal c, modulo 9. Turns of equal number stand by their digests.
    """
    ranged, starts = placed(turns, ["conv_id"], ["turn", "digest"], "turns")
    sizes = starts.select("conv_id", "n").distinct()
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = sizes.select("conv_id", "n", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"))
    taken = F.least("h", F.coalesce("m", F.lit(0)))
    convs = heads.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("m")), "base", "left")
    convs = stored(convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "convs")
    parts = starts.join(convs, "conv_id").select("part", "conv_id", (F.col("start") - F.col("first")).alias("shift"), "h", "taken")
    rows = stored(ranged.join(parts, ["part", "conv_id"]).withColumn("pos", F.col("at") + F.col("shift")), "turns")
    own = rows.filter("pos >= h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "n_bytes")
    first = rows.filter((F.col("pos") < HEADS - 1) & (F.col("conv_id") % GROUP == 0)).select(F.col("conv_id").alias("base"), "pos", "digest", "n_bytes")
    lent = first.join(convs.filter("taken > 0").select("conv_id", "base", "taken"), "base").filter("pos < taken")
    return own.union(lent.select("conv_id", F.col("pos") + 1, "digest", "n_bytes")), convs.select("conv_id", "length")


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, key, parent, n_bytes, ends``: every node on the path of each rebuilt conversation, the root too.

    A node's key is a digest of its depth and of the sums of four 32-bit words of each turn so far, hashed with their depths. Sums
    of prefixes need no task that sees a whole conversation.
    """
    rows, convs = rebuilt(turns)
    items = rows.select("conv_id", "depth", "n_bytes", *_words(F.col("digest"), F.col("depth")))
    ranged, starts = placed(items, ["conv_id"], ["depth"], "paths", sums=WORDS)
    joined = ranged.join(starts, ["part", "conv_id"])
    inside = Window.partitionBy("part", "conv_id").orderBy("at")
    sums = joined.withColumns({f"{w}_upto": F.col(f"{w}_start") + F.sum(w).over(inside) for w in WORDS})
    upto, before = [F.col(f"{w}_upto") for w in WORDS], [F.col(f"{w}_upto") - F.col(w) for w in WORDS]
    nodes = sums.select("conv_id", "depth", _key(F.col("depth"), upto).alias("key"), _key(F.col("depth") - 1, before).alias("parent"), "n_bytes", (F.col("depth") == F.col("n")).alias("ends"))
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), _root().alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("n_bytes"), (F.col("length") == 0).alias("ends"))
    return nodes.union(root)


class Sweep:
    """Subtree totals of the nodes of one shard after the other, deepest level first.

    Nodes come sorted by their labels (depth falling, key). A node's turn comes after those of all its children, each of which has sent
    ``(n_convs, n_leaves, saved)`` to its parent's label in the queue. Children of a single conversation are not
    nodes of a shard: they are the members that neither end here nor went on to a child of more, a leaf each.
    """

    def __init__(self, held: int = 1 << 16):
        self.held, self.queue = held, SpillingQueue(held)

    def node(self, row: tuple) -> tuple:
        key, parent, conv_id, depth, n_convs, n_ends, n_bytes, shard, met, convs, leaves, saved = row
        for n, below, spared in self.queue.take((-depth, key)):
            met, convs, leaves, saved = met + 1, convs + n, leaves + below, saved + spared
        alone = n_convs - n_ends - convs
        children = met + alone
        leaves, saved = leaves + alone + (not children), saved + (n_convs - 1) * n_bytes
        top = key == shard
        if not top:
            self.queue.push((1 - depth, parent), (n_convs, leaves, saved))
        return key, parent, conv_id, depth, n_convs, children, leaves, saved, top


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = Sweep()
    for batch in batches:
        yield _batch([sweep.node(row) for row in zip(*(c.to_pylist() for c in batch.columns))], TOTALS)


def _salt(conv_id: str = "conv_id") -> Column:
    return F.pmod(F.xxhash64(conv_id), F.lit(SALTS)).alias("salt")


def _copies(big: DataFrame, key: str, *more: str) -> DataFrame:
    """Nodes of many conversations with each salt: what a third of all rows joins is joined in ``SALTS`` parts."""
    return big.select(F.col("key").alias(key), *more, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))


def totals(nodes: DataFrame, steps: DataFrame, members: int = MEMBERS) -> DataFrame:
    """``TOTALS`` of every node of ``nodes`` (``key, parent, depth, conv_id, n_convs, n_bytes, n_ends``); ``steps`` are the ``paths``.

    A round takes the nodes of at most ``limit`` conversations. Its shards are the subtrees of the highest of them, so a
    shard has at most ``members`` nodes a level. The tops of shards send their totals on to their parents, which
    belong to a later round: there the limit is ``members`` times as high, until the root is in.
    """
    alone = nodes.filter("n_convs = 1").select(
        "key", "parent", "conv_id", "depth", "n_convs", (1 - F.col("n_ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.lit(False).alias("top"))
    most, done, limit, sent = nodes.agg(F.max("n_convs")).first()[0] or 0, 1, members, None
    out = alone
    while done < most:
        round_ = nodes.filter((F.col("n_convs") > done) & (F.col("n_convs") <= limit))
        if limit < most:
            big = stored(nodes.filter(F.col("n_convs") > limit).select("key"), "big")
            below = steps.withColumn("salt", _salt()).join(_copies(big, "parent"), ["parent", "salt"], "left_semi")
            tops = below.join(_copies(big, "key"), ["key", "salt"], "left_anti").select("conv_id", F.col("key").alias("shard"))
            round_ = round_.join(tops, "conv_id")
        else:
            round_ = round_.withColumn("shard", _root())
        none = F.lit(0).cast("long")
        if sent is None:
            round_ = round_.withColumns(dict.fromkeys(("met", "convs", "leaves", "saved"), none))
        else:
            round_ = round_.join(sent, "key", "left").fillna(0, ["met", "convs", "leaves", "saved"])
        order = [F.col("shard"), F.col("depth").desc(), F.col("key")]
        rows = round_.select("key", "parent", "conv_id", "depth", "n_convs", "n_ends", "n_bytes", "shard", "met", "convs", "leaves", "saved")
        swept = stored(rows.repartition("shard").sortWithinPartitions(*order).mapInArrow(_swept, TOTALS), "totals")
        out = out.union(swept)
        up = swept.filter("top AND parent IS NOT NULL").select("parent", F.lit(1).cast("long").alias("met"), F.col("n_convs").alias("convs"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        up = up if sent is None else up.union(sent.select(F.col("key").alias("parent"), "met", "convs", "leaves", "saved"))
        sent = stored(up.groupBy(F.col("parent").alias("key")).agg(*[F.sum(c).alias(c) for c in ("met", "convs", "leaves", "saved")]), "sent")
        done, limit = limit, limit * members
    return out


def parents(nodes: DataFrame, members: int = MEMBERS) -> DataFrame:
    """``conv_id, depth, parent_conv_id`` of the highest node of each conv_id; below it, the parent has the same conv_id."""
    highest = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth"))
    tops = highest.join(nodes.filter("parent IS NOT NULL").select("conv_id", "depth", "parent"), ["conv_id", "depth"]).withColumn("salt", _salt())
    name = F.col("conv_id").alias("parent_conv_id")
    big = _copies(stored(nodes.filter(F.col("n_convs") > members).select("key", name), "big"), "parent", "parent_conv_id")
    few = nodes.filter((F.col("n_convs") > 1) & (F.col("n_convs") <= members)).select(F.col("key").alias("parent"), name)
    hot = tops.join(big, ["parent", "salt"])
    cold = tops.join(big, ["parent", "salt"], "left_anti").join(few, "parent")
    return hot.select("conv_id", "depth", "parent_conv_id").union(cold.select("conv_id", "depth", "parent_conv_id"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node after the other, joined to texts of at most ``PIECE`` ids."""
    for batch in batches:
        rows: list[tuple] = []
        for key, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if not rows or key != rows[-1][0] or len(rows[-1][2]) == PIECE:
                rows.append((key, conv_id, []))
            rows[-1][2].append(str(conv_id))
        yield _batch([(key, start, ",".join(ids)) for key, start, ids in rows], PIECES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the joined pieces of each node, which come one after the other."""
    key, digest = None, None
    for batch in batches:
        done = []
        for found, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is not None and found == key:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                done.append((key, digest.hexdigest()))
            key, digest = found, hashlib.sha256(ids.encode())
        yield _batch(done, ENDS)
    yield _batch([] if digest is None else [(key, digest.hexdigest())], ENDS)


def ended(steps: DataFrame) -> DataFrame:
    """``key, ends_sha256``: sha256 of the rising, comma-joined ids of the conversations that end at a node.

    Ids meet in ranges of (node, id), where they are joined to pieces; one task then hashes the pieces of a node as they come.
    """
    ends = steps.filter("ends").select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ends.mapInArrow(_pieces, PIECES)
    return pieces.repartition("key").sortWithinPartitions("key", "start").select("key", "ids").mapInArrow(_digests, ENDS)


def trie(rows: DataFrame, members: int = MEMBERS) -> DataFrame:
    """A row for every node of the trie of rebuilt conversations (``conv_id, turn, role, text``; see ``rebuilt``).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Null and empty roles and texts are the same, rows without conv_id take no part,
    repeated rows are turns of their own, turns of equal number stand by their digests, null first. An empty table gives
    no rows, not even a root. Other columns play no part. Conversations may be copies of each other in any number.
    """
    steps = stored(paths(turns_of(rows)), "paths")
    grouped = steps.groupBy("key", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.sum(F.col("ends").cast("long")).alias("n_ends"))
    nodes = stored(grouped, "nodes")
    found = totals(nodes, steps, members).join(parents(nodes, members), ["conv_id", "depth"], "left").join(ended(steps), "key", "left")
    return found.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", F.when(F.col("parent").isNotNull(), F.col("conv_id"))).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
