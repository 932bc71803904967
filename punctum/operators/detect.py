"""Detection on chunk tables: the path for large images.

chunk rows --(cut to the blocks that read them)--> pieces --(one shuffle by image, block)-->
block arrays --(blur, DoG, peaks, centres)--> spots, no further shuffle.

Voxel rows go the same way, one row per pixel and block that reads it (``voxel_gather``).
Chunk pixels travel as arrays, so the shuffle moves 4 bytes per pixel times the halo factor; a group
is one block, whose size the settings bound. The pixel filters are the same definitions as the
relational operators in ``filters.py``, and tests hold the two to each other.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from punctum.functions import geometry as geo
from punctum.functions.arrow import batch_of, records, schema_of
from punctum.operators import blocks as blk
from punctum.operators import batched, intensity, localize
from punctum.params import MULTICONSENSUS, SpotParams, gauss_weights
from punctum.session import written
from punctum.sources.images import crop_voxels, stored_size

BLOCKS_PER_TASK, MOST_TASKS = 64, 200_000
#: Small blocks that a group holds at most, and the pixels it may hold unless one block has more.
BLOCKS_PER_GROUP, GROUP_PIXELS = 8, 1 << 16
PIECE = "image string, block_id bigint, v_low double, v_high double, {}, data array<float>"


def block_pieces(chunks: DataFrame, axes, params: SpotParams) -> DataFrame:
    """The part of every chunk that each block (with halo) reads.

    Block numbers come from arithmetic on the chunk's origin; chunks outside the crop read no
    block and vanish here. Pieces are cut before the shuffle.
    """
    n, block = len(axes), params.block(len(axes))
    halo = params.halo(n)
    lo, hi = blk.bounds(axes, *params.crop(n))
    out = _with_range(chunks, axes, params)
    for d, a in enumerate(axes):
        span = f"{a}0", f"({a}0 + w{a} - 1)"
        out = out.filter(geo.within_reach(*span, lo[d], hi[d], halo[d]))
        reading = geo.blocks_reading(*span, lo[d], hi[d], block[d], halo[d])
        out = out.selectExpr("*", f"coalesce({reading}, array()) AS b{a}", f"{lo[d]} AS l{a}", f"{hi[d]} AS h{a}", f"{geo.block_count(lo[d], hi[d], block[d])} AS k{a}")
    fields = [f + a for f in "blhk" for a in axes]
    out = out.select("image", "v_low", "v_high", *[a + "0" for a in axes], *["w" + a for a in axes], *["n" + a for a in axes], *fields, "data")
    columns = ["o" + a for a in axes] + ["w" + a for a in axes] + ["n" + a for a in axes] + ["b" + a for a in axes] + ["l" + a for a in axes] + ["h" + a for a in axes]
    schema = PIECE.format(", ".join(c + " bigint" for c in columns))

    arrow = schema_of(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in records(batch):
                get = lambda f: [int(getattr(c, f.format(a))) for a in axes]
                origin, width, size, low, high, count = (get(f) for f in ("{}0", "w{}", "n{}", "l{}", "h{}", "k{}"))
                array = c.data.reshape(width[::-1])
                rows = []
                for index in itertools.product(*[getattr(c, "b" + a).tolist() for a in axes]):
                    start, end = _extent(index, low, high, block, halo)
                    a0 = [max(s, o) for s, o in zip(start, origin)]
                    a1 = [min(e, o + w - 1) for e, o, w in zip(end, origin, width)]
                    if any(x > y for x, y in zip(a0, a1)):
                        continue
                    part = array[tuple(slice(x - o, y - o + 1) for x, y, o in zip(a0, a1, origin))[::-1]]
                    number = sum(i * math.prod(count[:d]) for d, i in enumerate(index))
                    rows.append((c.image, number, c.v_low, c.v_high, *a0, *part.shape[::-1], *size, *index, *low, *high, part.ravel()))
                yield batch_of(rows, arrow)

    return out.mapInArrow(cut, schema)


def _with_range(pixels: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Columns v_low, v_high: the fixed range, the image's range, or null for the block's own."""
    if not params.auto_range:
        return pixels.withColumns({"v_low": F.lit(float(params.min_intensity)), "v_high": F.lit(float(params.max_intensity))})
    if params.range_scope == "block":
        return pixels.withColumns({"v_low": F.lit(None).cast("double"), "v_high": F.lit(None).cast("double")})
    # Stored, so that its measured size decides how the pixels meet it: they don't move by image for a small table.
    return pixels.join(written(image_range(pixels, axes, params), "extent"), "image")


def _crop(pixels: DataFrame, axes, params: SpotParams) -> tuple[list, list]:
    """Inclusive bounds of the crop, per axis a Column."""
    first, last = params.crop(len(axes))
    return [F.lit(first[d] if first else 0) for d in range(len(axes))], [F.lit(last[d]) if last else F.col("n" + a) - 1 for d, a in enumerate(axes)]


def image_range(chunks: DataFrame, axes, params: SpotParams) -> DataFrame:
    """``image, v_low, v_high`` of the crop of each image; pixels of missing chunks are 0.

    A chunk within the crop counts by its least and largest value, which are stored beside it as ``v_min`` and ``v_max`` (a zone
    map; computed where the columns are missing), so its pixels aren't read. Pixels are read of the chunks the crop cuts,
    and only the numbers of those inside are taken; none moves.
    """
    lo, hi = _crop(chunks, axes, params)
    ends = [F.col(a + "0") + F.col("w" + a) - 1 for a in axes]
    low, high = [F.greatest(F.col(a + "0"), l) for a, l in zip(axes, lo)], [F.least(e, h) for e, h in zip(ends, hi)]
    touched = reduce(and_, [x <= y for x, y in zip(low, high)])
    within = reduce(and_, [(F.col(a + "0") >= l) & (e <= h) for a, l, e, h in zip(axes, lo, ends, hi)])
    met = chunks.filter(touched)
    count = lambda pairs: reduce(lambda a, b: a * b, [F.greatest(F.lit(0), y - x + 1).cast("bigint") for x, y in pairs])
    parts = count(zip(low, high)).alias("met")
    area = count([(F.greatest(l, F.lit(0)), F.least(h, F.col("n" + a) - 1)) for a, l, h in zip(axes, lo, hi)]).alias("area")
    zone = [F.col(f"v_{f}") if f"v_{f}" in chunks.columns else getattr(F, f"array_{f}")("data") for f in ("min", "max")]
    whole = met.filter(within).select("image", zone[0].cast("double").alias("v_min"), zone[1].cast("double").alias("v_max"), parts, area)
    if params.crop_min or params.crop_max:
        cut = met.filter(~within)
        inner = [(x - F.col(a + "0")).cast("int") for a, x in zip(axes, low)], [(y - x + 1).cast("int") for x, y in zip(low, high)]
        whole = whole.union(cut.select("image", *_cut_extremes(axes, *inner), parts, area))
    gap = F.when(F.sum("met") < F.max("area"), F.lit(0.0))
    return whole.groupBy("image").agg(F.least(F.min("v_min"), gap).alias("v_low"), F.greatest(F.max("v_max"), gap).alias("v_high"))


def _shifted(places: Column, first: Column, count: Column, step: Column) -> Column:
    """Every place plus ``first`` and ``count - 1`` steps more."""
    steps = F.transform(F.sequence(F.lit(0), count - 1), lambda k: first + k * step)
    return F.flatten(F.transform(places, lambda p: F.transform(steps, lambda s: p + s)))


def _cut_extremes(axes, first, count) -> list:
    """Least and largest value of the box of ``count`` pixels from ``first`` in a chunk's data, row by row of the first axis."""
    rows, stride = F.array(F.lit(0)), F.col("w" + axes[0])
    for d, a in enumerate(axes[1:], 1):
        rows = _shifted(rows, first[d] * stride, count[d], stride)
        stride = stride * F.col("w" + a)
    of = lambda f: F.transform(rows, lambda r: f(F.slice(F.col("data"), r + first[0] + 1, count[0])))
    return [F.array_min(of(F.array_min)).cast("double"), F.array_max(of(F.array_max)).cast("double")]


def _extent(index, low, high, block, halo):
    """Inclusive bounds of a block with its halo, not yet clipped to the image."""
    start = [int(l) + int(i) * (s - 2) for i, l, s in zip(index, low, block)]
    end = [min(s + b - 1, int(h)) for s, b, h in zip(start, block, high)]
    return [s - r for s, r in zip(start, halo)], [e + r for e, r in zip(end, halo)]


class Pixels(NamedTuple):
    """The assembled pixels of one block with its halo: where they start in the image, the image's size, the range to scale by, if given,
    and the inclusive interval that peaks must lie in, if it is not just the block's inner pixels."""

    image: str
    number: int
    start: list[int]
    size: list[int]
    raw: np.ndarray
    low: float | None
    high: float | None
    within: tuple[list[int], list[int]] | None = None


class Beside(NamedTuple):
    """Groups of chunks in place and of the slabs sent to them; a group is read from both tables."""

    chunks: GroupedData
    slabs: GroupedData

    def applyInArrow(self, run: Callable[[tuple[pa.Table, pa.Table]], pa.Table], schema: str) -> DataFrame:
        return self.chunks.cogroup(self.slabs).applyInArrow(lambda own, sent: run((own, sent)), schema)


class Together(NamedTuple):
    """Groups of some small blocks each, which are read one by one: a group costs more than the work of a small block, as it is a stream
    of its own to and from Python."""

    groups: GroupedData

    def applyInArrow(self, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        def every(table: pa.Table) -> pa.Table:
            table = table.take(pa.array(np.argsort(table["block_id"].to_numpy(), kind="stable"))).combine_chunks()
            number = table["block_id"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            return pa.concat_tables([run(table.slice(a, b - a)) for a, b in zip(edges, edges[1:])])

        return self.groups.applyInArrow(every, schema)


class Gather(NamedTuple):
    """Pixels on their way to blocks, from one shuffle: rows grouped by (image, block_id), how to read a group, and how to find
    the intensities of centres beyond their block."""

    groups: GroupedData | Beside | Together
    read: Callable[..., Pixels]
    beyond: Callable[[DataFrame], DataFrame]


def chunk_gather(chunks: DataFrame, axes, params: SpotParams, sizes: DataFrame | None = None) -> Gather:
    """Blocks from chunk rows. ``sizes``, one row per image, spares a pass over the chunks for the number of blocks."""
    ndim = len(axes)

    def read(table: pa.Table) -> Pixels:
        pieces = list(records(table))
        first = pieces[0]
        get = lambda f: [getattr(first, f + a) for a in axes]
        start, end = _extent(get("b"), get("l"), get("h"), params.block(ndim), params.halo(ndim))
        return Pixels(first.image, first.block_id, start, get("n"), _assemble(pieces, axes, start, end, get("n")), first.v_low, first.v_high)

    pieces, count = block_pieces(chunks, axes, params), _partitions(stored_size(chunks, axes) if sizes is None else sizes, axes, params)
    most = GROUP_PIXELS // math.prod(b + 2 * h for b, h in zip(params.block(ndim), params.halo(ndim)))
    if most < 2:
        groups = pieces.repartition(count, "image", "block_id").groupBy("image", "block_id")
    else:
        pieces = pieces.withColumn("part", F.expr(f"block_id div {min(most, BLOCKS_PER_GROUP)}"))
        groups = Together(pieces.repartition(count, "image", "part").groupBy("image", "part"))
    return Gather(groups, read, lambda spots: intensity.chunk_intensity(spots, chunks, axes))


def in_place_gather(chunks: DataFrame, axes, params: SpotParams, chunk) -> Gather:
    """Blocks that are the chunks of a table in buckets by (image, chunk_id) (``images.write_bucketed``), each read where it is stored.

    ``chunk`` is the chunk size per axis; the block around a chunk evaluates all its pixels but the outermost of the crop.
    Only slabs move: what the blocks around other chunks read of a chunk. A missing chunk next to stored ones is a block too.
    """
    halo, (first, last) = params.halo(len(axes)), params.crop(len(axes))
    lo, hi = _crop(chunks, axes, params)
    own = chunks
    for a, l, h in zip(axes, lo, hi):
        own = own.filter((F.col(a + "0") <= h - 1) & (F.col(a + "0") + F.col("w" + a) - 1 >= l + 1))
    places, sizes, widths = [f + "0" for f in axes], ["n" + a for a in axes], ["w" + a for a in axes]
    out = chunks.select("image", *places, *widths, *sizes, "data")
    for d, a in enumerate(axes):
        reach, size = halo[d] + 1, F.lit(chunk[d])
        from_, to = F.col(a + "0") - reach, F.col(a + "0") + F.col("w" + a) - 1 + reach
        low, high = F.greatest(from_, lo[d] + 1, F.lit(0)), F.least(to, hi[d] - 1, F.col("n" + a) - 1)
        steps = F.sequence(F.floor(low / size).cast("bigint"), F.floor(high / size).cast("bigint"))
        out = out.withColumn("b" + a, F.when(low <= high, steps))
    out = out.filter(reduce(and_, [F.col("b" + a).isNotNull() for a in axes]) & (reduce(lambda x, y: x * y, [F.size("b" + a) for a in axes]) > 0))
    schema = "image string, chunk_id bigint, {}, v_low double, v_high double, data array<float>".format(
        ", ".join(f"o{a} bigint, w{a} bigint, n{a} bigint" for a in axes))
    arrow = schema_of(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in records(batch):
                origin, width, size = ([int(getattr(c, f.format(a))) for a in axes] for f in ("{}0", "w{}", "n{}"))
                array, rows = c.data.reshape(width[::-1]), []
                for index in itertools.product(*[getattr(c, "b" + a).tolist() for a in axes]):
                    start, end = _around(index, chunk, halo)
                    a0, a1 = [max(s, o) for s, o in zip(start, origin)], [min(e, o + w - 1) for e, o, w in zip(end, origin, width)]
                    if all(i * s == o for i, s, o in zip(index, chunk, origin)) or any(x > y for x, y in zip(a0, a1)):
                        continue
                    part = array[tuple(slice(x - o, y - o + 1) for x, y, o in zip(a0, a1, origin))[::-1]]
                    places = [v for triple in zip(a0, part.shape[::-1], size) for v in triple]
                    rows.append((c.image, _number(index, size, chunk), *places, None, None, part.ravel()))
                yield batch_of(rows, arrow)

    slabs = out.mapInArrow(cut, schema)
    if params.auto_range and params.range_scope == "image":
        # A range goes to the blocks by their numbers, so no pixel is joined with it.
        met = out.select("image", *sizes, *["b" + a for a in axes])
        for a in axes:
            met = met.withColumn("b" + a, F.explode("b" + a))
        number = geo.linear_id(["b" + a for a in axes], [f"CAST(ceil(n{a} / {c}) AS BIGINT)" for a, c in zip(axes, chunk)])
        met = met.selectExpr("image", f"{number} AS chunk_id", *sizes).distinct().join(written(image_range(chunks, axes, params), "extent"), "image")
        places = [c for a in axes for c in (f"0L AS o{a}", f"0L AS w{a}", f"n{a}")]
        slabs = slabs.unionByName(met.selectExpr("image", "chunk_id", *places, "v_low", "v_high", "CAST(array() AS array<float>) AS data"))
    given = (None, None) if params.auto_range else (float(params.min_intensity), float(params.max_intensity))

    def read(tables: tuple[pa.Table, pa.Table]) -> Pixels:
        mine, sent = ([*records(t)] for t in tables)
        some = (mine or sent)[0]
        size = [int(getattr(some, "n" + a)) for a in axes]
        index = _place(int(some.chunk_id), size, chunk)
        start, end = _around(index, chunk, halo)
        # Beyond the image only the outermost pixels of a block and the halo count, as with any block.
        end = [min(e, n + h) for e, n, h in zip(end, size, halo)]
        low, high = next(((p.v_low, p.v_high) for p in sent if p.v_low is not None), given)
        within = [l + 1 for l in first or [0] * len(axes)], [h - 1 for h in (last or [n - 1 for n in size])]
        return Pixels(some.image, int(some.chunk_id), start, size, _assemble(mine + [p for p in sent if len(p.data)], axes, start, end, size), low, high, within)

    left = own.select("image", "chunk_id", *[F.col(a + "0").alias("o" + a) for a in axes], *widths, *sizes, "data")
    return Gather(Beside(left.groupBy("image", "chunk_id"), slabs.groupBy("image", "chunk_id")), read, lambda spots: intensity.chunk_intensity(spots, chunks, axes))


def _around(index, chunk, halo):
    """Inclusive bounds of the block around a chunk with its halo, not yet clipped to the image."""
    return [i * c - 1 - h for i, c, h in zip(index, chunk, halo)], [(i + 1) * c + h for i, c, h in zip(index, chunk, halo)]


def _number(index, size, chunk) -> int:
    """The chunk's number: the first axis runs fastest."""
    number = 0
    for i, n, c in reversed([*zip(index, size, chunk)]):
        number = number * -(-n // c) + int(i)
    return number


def _place(number: int, size, chunk) -> list[int]:
    index = []
    for n, c in zip(size, chunk):
        number, i = divmod(number, -(-n // c))
        index.append(i)
    return index


def voxel_gather(voxels: DataFrame, axes, params: SpotParams) -> Gather:
    """Blocks from voxel rows, each of which goes to the blocks that read it; missing voxels are 0."""
    ndim = len(axes)
    block, halo, (first, last) = params.block(ndim), params.halo(ndim), params.crop(ndim)
    lo, hi = blk.bounds(axes, first, last)
    out, counts = _voxel_range(voxels, axes, params), [geo.block_count(lo[d], hi[d], block[d]) for d in range(ndim)]
    for d, a in enumerate(axes):
        out = blk.read_along(out, a, lo[d], hi[d], block[d], halo[d])
    number = geo.linear_id(["b" + a for a in axes], counts)
    rows = out.selectExpr("image", f"{number} AS block_id", *axes, *["n" + a for a in axes], "v", "v_low", "v_high")

    def read(table: pa.Table) -> Pixels:
        one = lambda name: table[name][0].as_py()
        size = [one("n" + a) for a in axes]
        low, high = list(first or [0] * ndim), list(last or [n - 1 for n in size])
        index, rest = [], one("block_id")
        for l, h, s in zip(low, high, block):
            count = max(0, -(-(h - 1 - l) // (s - 2)))
            index, rest = [*index, rest % count], rest // count
        start, end = _extent(index, low, high, block, halo)
        inner = [max(s, 0) for s in start]
        raw = np.zeros([min(e, n - 1) - s + 1 for s, e, n in zip(inner, end, size)][::-1])
        raw[tuple(table[a].to_numpy() - s for a, s in zip(axes, inner))[::-1]] = table["v"].to_numpy()
        return Pixels(one("image"), one("block_id"), start, size, _mirrored(raw, start, end, size), one("v_low"), one("v_high"))

    groups = rows.repartition("image", "block_id").groupBy("image", "block_id")
    return Gather(groups, read, lambda spots: intensity.spot_intensity(spots, voxels, axes))


def _voxel_range(voxels: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Columns v_low, v_high of voxel rows: the fixed range, the image's (inside the crop), or null for the block's own."""
    if not params.auto_range or params.range_scope == "block":
        return _with_range(voxels, axes, params)
    inside = crop_voxels(voxels, axes, *_crop(voxels, axes, params))
    extent = inside.groupBy("image").agg(F.min("v").cast("double").alias("v_low"), F.max("v").cast("double").alias("v_high"))
    return voxels.join(written(extent, "extent"), "image")


class Block(NamedTuple):
    """Candidates of one block as positions in its array, in the order of the axes, with their DoG values."""

    pixels: Pixels
    span: float
    peaks: np.ndarray
    dog: np.ndarray


def candidates_of(pixels: Pixels, ndim: int, params: SpotParams) -> Block:
    halo, raw, low, high = params.halo(ndim), pixels.raw, pixels.low, pixels.high
    own = tuple(slice(r, n - r) for r, n in zip(halo[::-1], raw.shape))
    if low is None:
        low, high = float(raw[own].min()), float(raw[own].max())
    peaks, dog = np.zeros((0, ndim), np.int64), np.zeros(0)
    if high > low:
        v = (raw - low) / (high - low)
        response = _blur(v, params.sigmas(ndim), halo) - _blur(v, params.sigmas(ndim, wide=True), halo)
        found = _peaks(response, params.threshold)
        if pixels.within is not None:
            at = found[:, ::-1] + np.array(pixels.start) + np.array(halo)
            found = found[((at >= pixels.within[0]) & (at <= pixels.within[1])).all(axis=1)]
        peaks, dog = found[:, ::-1] + np.array(halo), response[tuple(found.T)]
    return Block(pixels, high - low, peaks, dog)


def block_candidates(gather: Gather, axes, params: SpotParams) -> DataFrame:
    """``image, block_id, x, y[, z], dog, span``: DoG peaks of every block with the width of the range used."""
    schema = f"image string, block_id bigint, {', '.join(a + ' bigint' for a in axes)}, dog double, span double"
    arrow, read = schema_of(schema), gather.read

    def run(table: pa.Table) -> pa.Table:
        found = candidates_of(read(table), len(axes), params)
        at = found.peaks + np.array(found.pixels.start)
        return table_of([found.pixels.image, found.pixels.number, *at.T, found.dog, found.span], len(at), arrow)

    return gather.groups.applyInArrow(run, schema)


def table_of(columns: list, rows: int, schema: pa.Schema) -> pa.Table:
    """A table of arrays and single values, which all rows share."""
    whole = (pa.array(c, f.type) if isinstance(c, np.ndarray) else c if isinstance(c, pa.Array) else pa.repeat(pa.scalar(c, f.type), rows) for c, f in zip(columns, schema))
    return pa.Table.from_arrays(list(whole), schema=schema)


def _partitions(sizes: DataFrame, axes, params: SpotParams) -> int:
    """Shuffle partitions of about ``BLOCKS_PER_TASK`` blocks, from the image sizes alone; at least the session's number.

    A given number also keeps small-in-bytes but slow blocks from being coalesced into few tasks.
    """
    lo, hi = blk.bounds(axes, *params.crop(len(axes)))
    count = " * ".join(f"CAST({geo.block_count(lo[d], hi[d], b)} AS BIGINT)" for d, b in enumerate(params.block(len(axes))))
    total = sizes.selectExpr(f"{count} AS n").agg(F.sum("n")).first()[0] or 0
    return max(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, -(-int(total) // BLOCKS_PER_TASK)))


def _assemble(pieces, axes, start, end, size):
    """One array over start..end: stored pixels, zeros where chunks are missing, mirrored borders."""
    a0 = [max(s, 0) for s in start]
    a1 = [min(e, n - 1) for e, n in zip(end, size)]
    out = np.zeros([e - s + 1 for s, e in zip(a0, a1)][::-1])
    for piece in pieces:
        o = [getattr(piece, "o" + a) - s for a, s in zip(axes, a0)]
        w = [getattr(piece, "w" + a) for a in axes]
        out[tuple(slice(i, i + n) for i, n in zip(o, w))[::-1]] = piece.data.reshape(w[::-1])
    return _mirrored(out, start, end, size)


def _mirrored(raw, start, end, size):
    """Pixels of the image with what mirrors beyond its borders, over start..end."""
    beyond = [(max(0, -s), max(0, e - n + 1)) for s, e, n in zip(start, end, size)][::-1]
    return np.pad(raw, beyond, mode="reflect") if any(map(any, beyond)) else raw


def _blur(v, sigmas, halo):
    """The blurred pixels of a block without its halo, which holds the kernels; each axis leaves fewer pixels to the next."""
    for d, (sigma, h) in enumerate(zip(sigmas, halo)):
        axis, kernel = v.ndim - 1 - d, gauss_weights(sigma)
        r, n = len(kernel) // 2, max(0, v.shape[axis] - 2 * h)
        moved = lambda k: v[(slice(None),) * axis + (slice(h + k, h + k + n),)]
        sides = sum(kernel[r + k] * (moved(-k) + moved(k)) for k in range(1, r + 1))
        v = kernel[r] * moved(0) + sides
    return v


def _peaks(response, threshold):
    """Positions (in array order) strictly above all neighbours and the threshold; never the outermost pixels."""
    if min(response.shape) < 3:
        return np.empty((0, response.ndim), dtype=int)
    centre = response[(slice(1, -1),) * response.ndim]
    keep = centre > threshold
    for step in itertools.product((0, 1, 2), repeat=response.ndim):
        if any(s != 1 for s in step):
            keep &= centre > response[tuple(slice(s, s + n) for s, n in zip(step, centre.shape))]
    return np.argwhere(keep) + 1


# --- centres -----------------------------------------------------------------------------


def _cube(axes, r: int) -> np.ndarray:
    return np.stack(np.meshgrid(*[np.arange(-r, r + 1)] * len(axes), indexing="ij"), axis=-1).reshape(-1, len(axes))


def _regions(block: Block, axes, params: SpotParams) -> Iterator[tuple]:
    """Slices of a block's candidates with their gradients, background subtracted, at the offsets of the cube, and the mask of those in the image."""
    cube, raster = _cube(axes, params.support_radius), batched.Raster(block.pixels.raw)
    factors = [params.anisotropy if a == "z" else 1.0 for a in axes]
    spots = block.peaks + np.array(block.pixels.start)
    for part in batched.slices(len(spots), len(cube), params):
        at = spots[part]
        mask = ((at[:, None] + cube >= 0) & (at[:, None] + cube < np.array(block.pixels.size))).all(axis=2)
        g = raster.gradients(block.peaks[part], cube, factors) / block.span
        yield part, at, cube, batched.subtract(cube, g, mask, params.support_radius, params), mask


def regions(gather: Gather, axes, params: SpotParams) -> DataFrame:
    """Support regions of all candidates (see ``support.support_region``), background subtracted, without another shuffle."""
    schema = ", ".join(["image string", *[f"{c}{a} bigint" for c in "sd" for a in axes], *[f"g{a} double" for a in axes]])
    arrow, read = schema_of(schema), gather.read

    def run(table: pa.Table) -> pa.Table:
        block, tables = candidates_of(read(table), len(axes), params), []
        for _, at, cube, g, mask in _regions(block, axes, params):
            spot, member = np.nonzero(mask)
            tables.append(table_of([block.pixels.image, *at[spot].T, *cube[member].T, *g[mask].T], len(spot), arrow))
        return pa.concat_tables(tables) if tables else arrow.empty_table()

    return gather.groups.applyInArrow(run, schema)


def detect(chunks: DataFrame, axes, params: SpotParams, sizes: DataFrame | None = None) -> DataFrame:
    """``image, block_id, x, y[, z], intensity, gradients, inliers``: all spots of all images."""
    return spots_of(chunk_gather(chunks, axes, params, sizes), axes, params)


def spots_of(gather: Gather, axes, params: SpotParams) -> DataFrame:
    """Spots of gathered blocks. Candidates are localized where their pixels are, in array operations, so only spots leave a block.

    A centre beyond its block and halo finds its intensity in the table of pixels; with a ``max_shift`` within the halo there is none,
    and nothing runs before the result is read.
    """
    ndim = len(axes)
    stretch = np.array(localize.scale(axes, params.anisotropy))
    schema = "image string, block_id bigint, {}, {}, {}, intensity double, gradients bigint, inliers bigint, round bigint".format(
        ", ".join(f"s{a} bigint" for a in axes), ", ".join(f"{a} double" for a in axes), ", ".join(f"n{a} bigint" for a in axes))
    arrow, read = schema_of(schema), gather.read

    def run(table: pa.Table) -> pa.Table:
        pixels = read(table)
        block, parts = candidates_of(pixels, ndim, params), []
        for part, at, cube, g, mask in _regions(block, axes, params):
            found = batched.fit([pixels.image] * len(at), at, np.broadcast_to(cube.astype(float), g.shape), g, mask, stretch, params)
            parts.append(found._replace(spot=found.spot + part.start))
        found = batched.joined(parts, ndim)
        inner = block.peaks[found.spot]
        values, here = batched.Raster(pixels.raw).interpolated(inner + found.centre)
        at = inner + np.array(pixels.start)
        columns = [pixels.image, pixels.number, *at.T, *(at + found.centre).T, *pixels.size, pa.array(values, mask=~here), found.gradients, found.inliers, found.round]
        return table_of(columns, len(at), arrow)

    spots = gather.groups.applyInArrow(run, schema)
    far = params.max_shift is None or params.max_shift > min(params.halo(ndim))
    if far or params.ransac == MULTICONSENSUS:
        spots = written(spots, "spots")  # small next to the pixels, and several steps read it
    beyond = spots.filter("intensity IS NULL")
    if far and not beyond.isEmpty():
        spots = spots.filter("intensity IS NOT NULL").unionByName(gather.beyond(beyond.drop("intensity")))
    spots = spots.drop(*["n" + a for a in axes])
    if params.ransac == MULTICONSENSUS:
        spots = localize.drop_weak_counts(spots, params)
    return intensity.intensity_threshold(spots, params.intensity_threshold)
