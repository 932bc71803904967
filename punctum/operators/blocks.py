"""Blocks over image tables: splitting, gathering with a halo, ownership."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.functions import udtf

from punctum.functions import geometry as geo
from punctum.functions.arrow import schema_of

#: Rows that are packed at once.
PACKED_ROWS = 1 << 18


def bounds(axes, crop_min=None, crop_max=None) -> tuple[list[str], list[str]]:
    """Inclusive interval per axis as SQL text; the whole image where no crop is given."""
    lo = [f"{0 if crop_min is None else int(crop_min[d])}L" for d in range(len(axes))]
    hi = [f"n{a} - 1" if crop_max is None else f"{int(crop_max[d])}L" for d, a in enumerate(axes)]
    return lo, hi


def split_blocks(images: DataFrame, axes, block, crop_min=None, crop_max=None) -> DataFrame:
    """``image, block_id`` and inclusive bounds ``x_min, x_max, ...`` of every block.

    ``images`` has one row per image with its size columns.
    """
    lo, hi = bounds(axes, crop_min, crop_max)
    out, kept = images, [c for c in images.columns if c not in {"n" + a for a in axes}]
    counts = [geo.block_count(lo[d], hi[d], block[d]) for d in range(len(axes))]
    for a, n in zip(axes, counts):
        out = out.selectExpr("*", f"explode(CASE WHEN {n} > 0 THEN sequence(0L, greatest({n} - 1, 0L)) END) AS b{a}")
    edges = []
    for d, a in enumerate(axes):
        edges.append(f"{geo.block_start('b' + a, lo[d], block[d])} AS {a}_min")
        edges.append(f"{geo.block_end('b' + a, lo[d], hi[d], block[d])} AS {a}_max")
    return out.selectExpr(*kept, f"{geo.linear_id(['b' + a for a in axes], counts)} AS block_id", *edges)


@udtf(returnType="block_id bigint, x_min bigint, x_max bigint, y_min bigint, y_max bigint")
class SplitBlocks2D:
    """SQL table function for 2D intervals, callable with LATERAL; ``split_blocks`` is the native form."""

    def eval(self, x_min: int, x_max: int, y_min: int, y_max: int, width: int, height: int):
        if min(width, height) < 3:
            raise ValueError("a block needs at least 3 pixels in every dimension")
        number = 0
        for y in range(y_min, y_max - 1, height - 2):
            for x in range(x_min, x_max - 1, width - 2):
                yield number, x, min(x + width - 1, x_max), y, min(y + height - 1, y_max)
                number += 1


@udtf(returnType="block_id bigint, x_min bigint, x_max bigint, y_min bigint, y_max bigint, z_min bigint, z_max bigint")
class SplitBlocks3D:
    """SQL table function for 3D intervals."""

    def eval(self, x_min: int, x_max: int, y_min: int, y_max: int, z_min: int, z_max: int, width: int, height: int, depth: int):
        number, sides = 0, ((z_min, z_max, depth), (y_min, y_max, height), (x_min, x_max, width))
        if min(width, height, depth) < 3:
            raise ValueError("a block needs at least 3 pixels in every dimension")
        for z, y, x in itertools.product(*[range(lo, hi - 1, size - 2) for lo, hi, size in sides]):
            yield number, x, min(x + width - 1, x_max), y, min(y + height - 1, y_max), z, min(z + depth - 1, z_max)
            number += 1


def read_by_blocks(voxels: DataFrame, axes, block, halo, crop_min=None, crop_max=None, mirrored: bool = True) -> DataFrame:
    """Every block's pixels plus ``halo`` pixels around it, one row per (block, position).

    Adds ``block_id``, ``inside`` (within the block's own bounds) and ``owned`` (this block
    evaluates the pixel). Positions beyond the image mirror; a crop does not, it reads on.
    This is an interval join done as arithmetic and explode, with no join and no shuffle.
    """
    lo, hi = bounds(axes, crop_min, crop_max)
    out, inside, owned = voxels, [], []
    counts = [geo.block_count(lo[d], hi[d], block[d]) for d in range(len(axes))]
    for d, a in enumerate(axes):
        b = "b" + a
        out = _explode_axis(out, a, lo[d], hi[d], block[d], halo[d], halo[d] if mirrored else 0)
        inside.append(f"{a} BETWEEN {geo.block_start(b, lo[d], block[d])} AND {geo.block_end(b, lo[d], hi[d], block[d])}")
        owned.append(f"{geo.block_owner(a, lo[d], hi[d], block[d])} <=> {b}")
    number = geo.linear_id(["b" + a for a in axes], counts)
    return out.selectExpr(*voxels.columns, f"{number} AS block_id", f"({' AND '.join(inside)}) AS inside", f"({' AND '.join(owned)}) AS owned")


def _explode_axis(df: DataFrame, a: str, lo: str, hi: str, size: int, halo: int, mirrored: int) -> DataFrame:
    """One row per position that pixel ``a`` stands for and block ``b<a>`` that reads that position."""
    if mirrored > 0:
        others = [c for c in df.columns if c != a]
        df = df.selectExpr(*others, f"explode({geo.mirror_images(a, 'n' + a, mirrored)}) AS {a}").filter(f"{a} IS NOT NULL")
    return df.selectExpr("*", f"explode({geo.blocks_reading(a, a, lo, hi, size, halo)}) AS b{a}")


def packed(gathered: DataFrame, axes, block, halo, crop_min=None, crop_max=None, beside: tuple[str, ...] = (), margin: int = 0) -> DataFrame:
    """Rows of ``read_by_blocks`` (or, with a ``margin`` of 1, of ``tiled``) packed for a shuffle: ``image, block_id, nx, ny[, nz], *beside, steps, v``.

    A row has pixels of one block that come near each other in the input; ``steps`` are the differences of their places in the block with
    its halo, the first axis fastest, so they are mostly 1 and take next to no room (``places_of`` reads them). ``beside`` are columns of an image.
    ``margin``: by how much the interval is larger than an image without a crop, on each side.
    """
    low, high, shape = crop_min or [-margin] * len(axes), crop_max, [s + 2 * h for s, h in zip(block, halo)]
    own = ["image", "block_id", *["n" + a for a in axes], *beside]
    kinds = dict(gathered.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in own], "steps array<int>", "v array<double>"])
    arrow = schema_of(schema)

    def rows_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: rows[name].combine_chunks()
        get = lambda name: column(name).to_numpy(zero_copy_only=False).astype(np.int64)
        image = pc.dictionary_encode(column("image"), null_encoding="encode").indices.to_numpy()
        number, place, stride = get("block_id"), np.zeros(len(rows), np.int64), 1
        rest = number
        for d, a in enumerate(axes):
            last = get("n" + a) - 1 + margin if high is None else int(high[d])
            index, rest = _index(rest, low[d], last, block[d])
            place += (get(a) - (low[d] + index * (block[d] - 2) - halo[d])) * stride
            stride *= shape[d]
        order = np.lexsort((number, image))
        image, number, place = image[order], number[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], (image[1:] != image[:-1]) | (number[1:] != number[:-1]))))
        steps = np.diff(place, prepend=0)
        steps[first] = place[first]
        ends = pa.array(np.concatenate((first, [len(rows)])).astype(np.int32))
        values = column("v").cast(pa.float64()).take(pa.array(order))
        lists = [pa.ListArray.from_arrays(ends, part) for part in (pa.array(steps.astype(np.int32)), values)]
        heads = [column(c).take(pa.array(order[first])).cast(f.type) for c, f in zip(own, arrow)]
        return pa.RecordBatch.from_arrays([*heads, *lists], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting, count = [*waiting, batch], count + batch.num_rows
            if count >= PACKED_ROWS:
                yield rows_of(waiting)
                waiting, count = [], 0
        if waiting:
            yield rows_of(waiting)

    if math.prod(shape) >= 1 << 31:
        raise ValueError(f"a block of {block} pixels with a halo of {halo} is too large")
    return gathered.select(*own, *axes, "v").mapInArrow(run, schema)


def _index(number, lo, hi, size: int):
    """A block's place along one axis from its number, and the number of its place along the next axes."""
    count = np.maximum(1, -(-(hi - 1 - lo) // (size - 2)))
    return number % count, number // count


def places_of(table: pa.Table, block, halo) -> tuple[list[np.ndarray], pa.Array]:
    """Places of the pixels in the block of which ``table`` has the rows of ``packed``, per axis in the order of the axes, and their values."""
    steps, taken = (table[c].combine_chunks() for c in ("steps", "v"))
    lengths = np.diff(np.asarray(steps.offsets))
    place = np.cumsum(steps.flatten().to_numpy(), dtype=np.int64)
    # The places begin anew with each row.
    begin = np.cumsum(lengths) - lengths
    place -= np.repeat(np.where(begin > 0, place[begin - 1], 0), lengths)
    at = []
    for side, r in zip(block, halo):
        at.append(place % (side + 2 * r))
        place //= side + 2 * r
    return at, taken.flatten()


class Box(NamedTuple):
    """The pixels of one block with its halo, the first axis last. ``start``: the position of the first pixel, per axis in the order of the axes;
    ``null``: pixels without a value; ``inside``: the block's own pixels; ``owned``: those it evaluates."""

    start: list[int]
    values: np.ndarray
    null: np.ndarray
    inside: tuple[slice, ...]
    owned: tuple[slice, ...]


def box_of(table: pa.Table, axes, block, halo, crop_min=None, crop_max=None, gap: float = 0.0) -> Box:
    """The block of which ``table`` has the rows of ``packed``. A pixel of the image without a row is ``gap``. Without a crop the rows need no
    mirrored copies, as a block reads all pixels that mirror into it."""
    low, size = crop_min or [0] * len(axes), [table["n" + a][0].as_py() for a in axes]
    start, shape, inside, owned, rest = [], [], [], [], table["block_id"][0].as_py()
    for d, r in enumerate(halo):
        last = size[d] - 1 if crop_max is None else int(crop_max[d])
        index, rest = map(int, _index(rest, low[d], last, block[d]))
        first = low[d] + index * (block[d] - 2)
        width = min(first + block[d] - 1, last) - first + 1
        start.append(first - r)
        shape.append(width + 2 * r)
        inside.append(slice(r, r + width))
        owned.append(slice(r + 1, r + width - 1))
    values, null = np.full(shape[::-1], gap), np.zeros(shape[::-1], bool)
    for d, (s, n, r) in enumerate(zip(start, size, halo)):
        # No pixel mirrors to what is more than the halo beyond the image.
        at = s + np.arange(shape[d])
        null[(slice(None),) * (len(axes) - 1 - d) + ((at < -r) | (at >= n + r),)] = True
    at, taken = places_of(table, block, halo)
    at = tuple(at[::-1])
    values[at] = taken.fill_null(gap).to_numpy()
    null[at] = taken.is_null().to_numpy(zero_copy_only=False)
    for d, (s, n) in enumerate(zip(start, size)):
        at, axis = s + np.arange(shape[d]), len(axes) - 1 - d
        if crop_min is None and crop_max is None and (at[0] < 0 or at[-1] >= n):
            source = n - 1 - np.abs(at % (2 * (n - 1)) - (n - 1)) - s
            values, null = np.take(values, source, axis), np.take(null, source, axis)
    return Box(start, values, null, tuple(inside[::-1]), tuple(owned[::-1]))


def read_along(df: DataFrame, a: str, lo: str, hi: str, size: int, halo: int) -> DataFrame:
    """One row per block ``b<a>`` that reads pixel ``a``, without mirrored copies."""
    return _explode_axis(df, a, lo, hi, size, halo, 0)


#: Size of tiles by the number of axes.
TILE = {2: (256, 256), 3: (64, 64, 64)}


def tiles(voxels: DataFrame, axes, reach, size=None) -> DataFrame:
    """Cover every pixel of every image exactly once with blocks that see ``reach`` pixels around it.

    One shuffle by (image, block) follows; windows along any axis inside a block need no other.
    """
    return tiled(voxels, axes, reach, size).repartition("image", "block_id")


def tiled(voxels: DataFrame, axes, reach, size=None) -> DataFrame:
    """The rows of ``tiles`` where the pixels are, before any shuffle."""
    size = size or TILE[len(axes)]
    halo = [max(0, r - 1) for r in reach]
    # The interval one pixel larger than the image: its evaluated pixels are the whole image.
    lo, hi = ["-1L"] * len(axes), ["n" + a for a in axes]
    counts = [geo.block_count(lo[d], hi[d], size[d]) for d in range(len(axes))]
    out, owned = voxels, []
    for d, a in enumerate(axes):
        out = _explode_axis(out, a, lo[d], hi[d], size[d], halo[d], halo[d] + 1)
        owned.append(f"{geo.block_owner(a, lo[d], hi[d], size[d])} <=> b{a}")
    number = geo.linear_id(["b" + a for a in axes], counts)
    return out.selectExpr(*voxels.columns, f"{number} AS block_id", f"({' AND '.join(owned)}) AS owned")


def tile_start(number: int, size, tile) -> list[int]:
    """The first position a tile reads, per axis, from its number and the size of the image."""
    start = []
    for n, side in zip(size, tile):
        index, number = map(int, _index(number, -1, n, side))
        start.append(index * (side - 2) - 1)
    return start


def evaluated(axes, crop_min=None, crop_max=None) -> str:
    """Pixels that may become spots: all but the outermost of the interval."""
    lo, hi = bounds(axes, crop_min, crop_max)
    return " AND ".join(f"{a} BETWEEN {lo[d]} + 1 AND {hi[d]} - 1" for d, a in enumerate(axes))
