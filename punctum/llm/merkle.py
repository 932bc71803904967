"""A Merkle manifest of a dataset: digests up the tree, then proofs down, by time-forward processing in shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from punctum.functions.arrow import schema_of
from punctum.llm.common import stored
from punctum.llm.spilling import SpillingQueue, placed

FAN = 16
#: Levels of the tree inside one shard: a shard has at most FAN ** LEVELS nodes at its bottom.
LEVELS = 3
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = "places array<int>, others array<string>"


def leaf_digest(*fields: Column) -> Column:
    """sha256 of the fields: ``-`` for a null, else the number of UTF-8 bytes, ``:`` and the value."""
    texts = [field.cast("string") for field in fields]
    coded = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def digest_of(digests: str) -> str:
    return hashlib.sha256(digests.encode()).hexdigest()


def height(n: int, fan: int = FAN) -> int:
    """Levels above ``n`` nodes: runs of ``fan`` nodes become one until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def upward(digests: Iterator[str], levels: int, fan: int = FAN, held: int = 1 << 16) -> tuple[str, list[tuple]]:
    """The digest ``levels`` above the nodes, and ``(label, digests of its children)`` of every node met, in order of labels.

    A label is (level, place in the level). Nodes come out of the queue by label, so every child
    has sent its digest to its parent's label before the parent's turn.
    """
    queue, families = SpillingQueue(held), []
    for place, digest in enumerate(digests):
        queue.push((1, place // fan), digest)
    while queue:
        label = queue.first()
        children = "".join(queue.take(label))
        if label[0] > levels:
            return children, families
        families.append((label, children))
        queue.push((label[0] + 1, label[1] // fan), digest_of(children))
    return "", families


def downward(families: list[tuple], suffix: tuple, fan: int = FAN, held: int = 1 << 16) -> Iterator[tuple]:
    """``(place, proof)`` of the nodes at the bottom, in falling order of places.

    A proof is two tuples, one entry a level upward: the node's place in its run, and the digests of the others there.
    The sweep goes through the labels backwards; every node finds the proof of its parent's place in the
    queue and sends it on to its children with their own level before it.
    """
    queue = SpillingQueue(held)
    if families:
        level, place = families[-1][0]
        queue.push((-level, -place), suffix)
    for (level, index), children in reversed(families):
        (places, others), = queue.take((-level, -index))
        for place in range(len(children) // DIGEST - 1, -1, -1):
            rest = children[: place * DIGEST] + children[(place + 1) * DIGEST :]
            queue.push((1 - level, -(index * fan + place)), ((place, *places), (rest, *others)))
    while queue:
        (_, place), proof = queue.pop()
        yield -place, proof


def _levels(n: Column, fan: int, levels: int) -> Column:
    """Levels that one round adds above a group of ``n`` nodes; fewer than ``levels`` where one node is left earlier."""
    steps = F.lit(0)
    for k in range(levels):
        steps = steps + F.when(n > fan**k, 1).otherwise(0)
    return steps.cast("int")


def _sharded(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """Adds the steps of the round and ``shard``, the place of the node that many levels above."""
    steps = _levels(F.col("n"), fan, levels)
    return nodes.withColumn("steps", steps).withColumn("shard", F.floor(F.col("pos") / F.pow(F.lit(fan), steps)).cast("long"))


def _raised(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """One row for each shard: ``tree, pos, n, digest`` of its top."""

    def tops(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        steps, n = table["steps"][0].as_py(), table["n"][0].as_py()
        digest, _ = upward(iter(table["digest"].to_pylist()), steps, fan)
        row = [table["tree"][:1].to_pylist(), table["shard"][:1].to_pylist(), [-(-n // fan**steps)], [digest]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

    schema = schema_of("tree string, pos bigint, n bigint, digest string")
    below = _sharded(nodes, fan, levels).select("tree", "shard", "pos", "n", "steps", "digest")
    return below.groupBy("tree", "shard").applyInArrow(tops, "tree string, pos bigint, n bigint, digest string")


def _lowered(nodes: DataFrame, tops: DataFrame, keep: list[str], fan: int, levels: int) -> DataFrame:
    """``keep``, the digest ``top`` of the tree and the proof of every node, from those of the tops of their shards."""

    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema)
        table, above = table.sort_by("pos"), above.to_pylist()[0]
        suffix = (tuple(above["places"]), tuple(above["others"]))
        _, families = upward(iter(table["digest"].to_pylist()), table["steps"][0].as_py(), fan)
        found = [proof for _, proof in sorted(downward(families, suffix, fan))] if families else [suffix]
        lists = [pa.array(column, kind) for column, kind in zip(zip(*found), schema.types[-2:])]
        return pa.Table.from_arrays([*(table[c] for c in keep), pa.array([above["top"]] * table.num_rows, pa.string()), *lists], schema=schema)

    kept = [f for f in nodes.schema if f.name in keep]
    keep = [f.name for f in kept]
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"top string, {PROOF}"])
    schema = schema_of(shape)
    below = _sharded(nodes, fan, levels).select(*dict.fromkeys(["tree", "shard", "pos", "steps", "digest", *keep]))
    above = tops.select("tree", F.col("pos").alias("shard"), "top", "places", "others")
    return below.groupBy("tree", "shard").cogroup(above.groupBy("tree", "shard")).applyInArrow(proofs, shape)


def _positions(rows: DataFrame, order: list[str], label: str) -> tuple[DataFrame, int]:
    """Adds ``pos``, from 0 in the order of a row within its ``tree``, and ``n``, the number of rows of the tree; and the largest ``n``."""
    ranged, starts = placed(rows, ["tree"], order, label)
    nodes = ranged.join(starts, ["part", "tree"]).withColumn("pos", F.col("at") - F.col("first") + F.col("start"))
    return nodes.drop("at", "part", "first", "start"), starts.agg(F.max("n")).first()[0] or 0


def _climbed(nodes: DataFrame, most: int, fan: int, levels: int) -> list[DataFrame]:
    """The tables of nodes of all rounds, from the given one to one with a single node for each tree."""
    rounds = [nodes]
    while most > 1:
        rounds.append(stored(_raised(rounds[-1], fan, levels), "merkle"))
        most = -(-most // fan ** min(levels, height(most, fan)))
    return rounds


def _descended(rounds: list[DataFrame], tops: DataFrame, keep: list[str], fan: int, levels: int) -> DataFrame:
    """``keep``, ``top`` and proofs of the nodes of the first round, from those of the single nodes of the trees (``tree, pos, top, places, others``)."""
    if len(rounds) == 1:
        return rounds[0].select(*dict.fromkeys(["tree", *keep])).join(tops.drop("pos"), "tree").select(*keep, "top", "places", "others")
    for nodes in rounds[-2:0:-1]:
        tops = stored(_lowered(nodes, tops, ["tree", "pos"], fan, levels), "proofs")
    return _lowered(rounds[0], tops, keep, fan, levels)


def manifest(leaves: DataFrame, keep: tuple[str, ...] = (), fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``doc_id, source, leaf``, ``keep``, ``subroot, root, places, others`` for every row of ``leaves``.

    ``leaves`` has ``doc_id``, ``source`` and the hex digest ``leaf``. The leaves of a source stand by doc_id (null first,
    equal ids by their digest); while a tree has more than one node, every ``fan`` consecutive ones become the digest
    of their digests, one after the other, the last run also if it is a single node. The subroots, by source (null first, else
    by UTF-8 bytes), form the tree above in the same way. ``places`` and ``others`` are a leaf's proof: for each
    level, up to the root, its place in its run and the digests of the others; ``folded`` computes the root from them.

    Both sweeps are time-forward processing within shards of at most ``fan ** levels`` nodes, first over the shards of
    leaves, then over the shards of their tops, until one is left; the sweep back goes the same way down. A source of
    any size is many shards. Repeated rows are leaves of their own, a source of one row has it as its subroot,
    and an empty table gives no rows. Null fields are part of a leaf's digest; columns not named in ``keep`` play no part.
    """
    source = F.col("source").cast("string")
    tree = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), source))
    rows = leaves.select("doc_id", "source", "leaf", *keep, tree.alias("tree"), F.col("leaf").alias("digest"))
    nodes, most = _positions(rows, ["doc_id", "leaf"], "leaves")
    rounds = _climbed(nodes, most, fan, levels)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    above, most = _positions(subroots, ["name"], "subroots")
    upper = _climbed(above, most, fan, levels)
    whole = upper[-1].first()
    none = [F.expr(f"cast(array() as {kind})").alias(name) for name, kind in (p.split() for p in PROOF.split(", "))]
    top = upper[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.col("digest").alias("top"), *none)
    paths = _descended(upper, top, ["name", "digest"], fan, levels)
    tops = stored(paths.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("top"), "places", "others"), "paths")
    proofs = _descended(rounds, tops, ["doc_id", "source", "leaf", *keep], fan, levels)
    root = F.lit(whole.digest if whole else None).cast("string").alias("root")
    return proofs.select("doc_id", "source", "leaf", *keep, F.col("top").alias("subroot"), root, "places", "others")


def folded(leaf: Column, places: Column, others: Column) -> Column:
    """The root that a leaf gives with its proof."""
    steps = F.arrays_zip(places.alias("place"), others.alias("rest"))
    run = lambda d, s: F.concat(F.substring(s["rest"], F.lit(1), s["place"] * DIGEST), d, F.substring(s["rest"], s["place"] * DIGEST + 1, F.length(s["rest"])))
    return F.aggregate(steps, leaf, lambda d, s: F.sha2(run(d, s).cast("binary"), 256))
