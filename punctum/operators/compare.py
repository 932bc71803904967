"""Comparison of two spot tables ``id, x, y[, z]``: nearest neighbours and unmatched spots.

Points and queries are dealt together into ranges of a space-filling curve, so ranges follow the density and a query mostly lies with
its neighbours. Each task builds a KD-tree of its points and answers its queries. A query whose ball touches
the box of another range goes there too, once, and keeps the best. Exact for any distance and clustering, without a cross join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from punctum.functions.arrow import schema_of
from punctum.functions.trees import Tree, to_boxes
from punctum.session import written

#: Bits of the curve: all axes together.
BITS = 60
#: Points in one row of a stored range; queries that one task takes of those that come to one range.
PACKED, TAKEN = 1 << 16, 1 << 20
NONE = np.iinfo(np.int64).max


def curve(axes, low: dict[str, float], extent: float) -> Column:
    """Place on the curve that interleaves the bits of the coordinates; positions outside count as the nearest inside."""
    bits = BITS // len(axes)
    place = F.lit(0).cast("bigint")
    for d, a in enumerate(axes):
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(a) - F.lit(low[a])) / F.lit(extent)))
        cell = F.least(F.floor(share * F.lit(float(1 << bits))), F.lit(float((1 << bits) - 1))).cast("bigint")
        for b in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(axes) + d))
    return place


def _arrays(table: pa.Table | pa.RecordBatch, axes) -> np.ndarray:
    return np.stack([table.column(a).to_numpy(zero_copy_only=False) for a in axes], axis=1) if table.num_rows else np.zeros((0, len(axes)))


def _ranges(rows: DataFrame, axes) -> DataFrame:
    """Points and queries (``match_id`` null) of each range: queries with the nearest point of it, points packed with their box.

    ``part`` is the range, ``number`` tells query rows apart.
    """
    axes = list(axes)
    plain = ", ".join(f"{a} double" for a in axes)
    lists = ", ".join(f"p{a} array<double>" for a in axes)
    shape = f"part bigint, number bigint, id bigint, {plain}, match_id bigint, distance double, {lists}, ids array<bigint>"
    schema = schema_of(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        asks = table["match_id"].is_null()
        points, queries = table.filter(pa.compute.invert(asks)), table.filter(asks)
        at, numbers = _arrays(points, axes), points["match_id"].to_numpy()
        for k in range(0, len(at), PACKED):
            some = slice(k, k + PACKED)
            packed = [pa.array([at[some, d]], pa.list_(pa.float64())) for d in range(len(axes))]
            nulls = [pa.nulls(1, f.type) for f in schema][1 : len(axes) + 5]
            yield pa.RecordBatch.from_arrays([pa.array([part]), *nulls, *packed, pa.array([numbers[some]], pa.list_(pa.int64()))], schema=schema)
        here, n = _arrays(queries, axes), queries.num_rows
        distance, number = np.full(n, np.inf), np.full(n, NONE)
        if n and len(at):
            distance, number = Tree(at, numbers).nearest(here, distance, number)
        ids = queries["id"].combine_chunks()
        columns = [pa.array(np.full(n, part)), pa.array((part << 33) + np.arange(n)), ids, *here.T, pa.array(number), pa.array(distance)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *[pa.nulls(n, f.type) for f in schema][len(axes) + 5 :]], schema=schema)

    return rows.mapInArrow(run, shape)


def _routed(queries: DataFrame, axes, parts: np.ndarray, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Queries with ``to``: another range whose box is within the distance, a row for each; null if there is none.

    Each box has a point no farther than its farthest corner, which bounds queries that lie in a range without points.
    """
    axes = list(axes)
    shape = f"number bigint, id bigint, {', '.join(f'{a} double' for a in axes)}, match_id bigint, distance double, to bigint"
    schema = schema_of(shape)
    step = max(1, (1 << 20) // max(1, len(parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                q, best, own = _arrays(some, axes)[:, None], some.column("distance").to_numpy(), some.column("part").to_numpy()
                far = np.sqrt((np.maximum(np.abs(q - low), np.abs(q - high)) ** 2).sum(axis=2)).min(axis=1)
                near = (to_boxes(q, low, high) <= np.minimum(best, far)[:, None] * (1 + 1e-9)) & (parts != own[:, None])
                row, box = np.nonzero(near)
                alone = np.flatnonzero(~near.any(axis=1))
                take = np.concatenate([row, alone])
                kept = [some.column(c).take(pa.array(take)) for c in ("number", "id", *axes, "match_id", "distance")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate([parts[box], np.zeros(len(alone), np.int64)]), mask=np.arange(len(take)) >= len(row))], schema=schema)

    return queries.select("part", "number", "id", *axes, "match_id", "distance").mapInArrow(run, shape)


def _answered(asked: DataFrame, points: DataFrame, axes) -> DataFrame:
    """Queries that came to a range, with the better of what they had and its nearest point.

    A range that many queries come to is answered in several tasks.
    """
    axes = list(axes)
    counts = asked.groupBy("to").count().filter(F.col("count") > TAKEN).collect()
    salts = F.lit(1)
    for r in counts:
        salts = F.when(F.col("to") == r.to, F.lit(-(-r["count"] // TAKEN))).otherwise(salts)
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("number"), salts).cast("bigint"))
    points = points.withColumnRenamed("part", "to").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1).cast("array<bigint>")))
    shape = "number bigint, id bigint, match_id bigint, distance double"
    schema = schema_of(shape)

    def run(queries: pa.Table, packed: pa.Table) -> pa.Table:
        if not queries.num_rows:
            return schema.empty_table()
        at = np.stack([packed[f"p{a}"].combine_chunks().flatten().to_numpy() for a in axes], axis=1)
        tree = Tree(at, packed["ids"].combine_chunks().flatten().to_numpy())
        distance, number = tree.nearest(_arrays(queries, axes), queries["distance"].to_numpy(), queries["match_id"].to_numpy())
        return pa.Table.from_arrays([queries["number"], queries["id"], pa.array(number), pa.array(distance)], schema=schema)

    return asked.groupBy("to", "salt").cogroup(points.groupBy("to", "salt")).applyInArrow(run, shape)


def nearest(queries: DataFrame, points: DataFrame, axes) -> DataFrame:
    """``id, match_id, distance``: nearest point of each query; ties go to the smallest id.

    A query with a null coordinate, and every query if there are no points, has no match. Queries move twice at most, by the curve and
    to ranges their ball touches; the boxes of the ranges, one a task, are all the driver sees.
    """
    axes = list(axes)
    known = reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in axes])
    queries = queries.select("id", *[F.col(a).cast("double").alias(a) for a in axes])
    none = lambda rows: rows.select("id", F.lit(None).cast("bigint").alias("match_id"), F.lit(None).cast("double").alias("distance"))
    places = points.filter(known).select("id", *[F.col(a).cast("double").alias(a) for a in axes]).groupBy(*axes).agg(F.min("id").alias("match_id"))
    places = written(places, "places")
    stats = places.agg(*[f(a).alias(f.__name__ + a) for a in axes for f in (F.min, F.max)]).first()
    if stats["min" + axes[0]] is None:
        return none(queries)
    low = {a: stats["min" + a] for a in axes}
    extent = max(stats["max" + a] - low[a] for a in axes) or 1.0
    both = places.select(F.lit(None).cast("bigint").alias("id"), *axes, "match_id")
    both = both.unionByName(queries.filter(known).withColumn("match_id", F.lit(None).cast("bigint"))).withColumn("place", curve(axes, low, extent))
    ranged = written(_ranges(both.repartitionByRange("place", *axes, "id").drop("place"), axes), "ranges")
    packed, asked = ranged.filter("ids IS NOT NULL").select("part", *["p" + a for a in axes], "ids"), ranged.filter("ids IS NULL")
    ends = [f(f"p{a}").alias(f.__name__[6:] + a) for a in axes for f in (F.array_min, F.array_max)]
    box = [f(f.__name__ + a).alias(f.__name__ + a) for a in axes for f in (F.min, F.max)]
    boxes = packed.select("part", *ends).groupBy("part").agg(*box).collect()
    side = lambda f: np.array([[r[f + a] for a in axes] for r in boxes])
    routed = _routed(asked, axes, np.array([r.part for r in boxes]), side("min"), side("max"))
    moved = _answered(routed.filter("to IS NOT NULL"), packed, axes)
    best = moved.groupBy("number", "id").agg(F.min(F.struct("distance", "match_id")).alias("best"))
    found = routed.filter("to IS NULL").select("id", "match_id", "distance").union(best.select("id", "best.match_id", "best.distance"))
    return found.union(none(queries.filter(~known)))


def unmatched(queries: DataFrame, points: DataFrame, axes, tolerance: float = 0.01) -> DataFrame:
    """``id, distance``: spots whose nearest counterpart is at ``tolerance`` or farther.

    Spots that share a cell of edge tolerance / sqrt(n) with a counterpart are matched for sure
    and leave before any distance is computed.
    """
    edge = tolerance * (1 - 1e-9) / math.sqrt(len(axes))
    cell = [F.floor(F.col(a) / F.lit(edge)).alias("c" + a) for a in axes]
    occupied = points.select(*cell).distinct()
    left = queries.select("id", *axes, *cell).join(occupied, ["c" + a for a in axes], "left_anti").drop(*["c" + a for a in axes])
    return nearest(left, points, axes).filter(F.col("distance").isNull() | (F.col("distance") >= tolerance)).select("id", "distance")


def sort_spots(spots: DataFrame, axes) -> DataFrame:
    return spots.orderBy(*axes)
