"""Pixel filters over voxel tables: normalization, blur, difference of Gaussians, peaks, gradients.

All work inside blocks that carry their own halo (``blocks.py``). The block gather is the
one shuffle; every window below partitions by (image, block_id, ...), which that shuffle
already satisfies, so each axis costs a local sort and no exchange. Peaks and gradients need no
window: their blocks are packed before the shuffle and are filtered as arrays. A block is bounded, so
neither a huge image nor a long scan line lands in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from punctum.functions.arrow import schema_of
from punctum.operators import blocks as blk
from punctum.params import SpotParams, gauss_weights, radius
from punctum.session import written
from punctum.sources.images import size_columns

BLOCK = ("image", "block_id")


def _along(axes, axis) -> str:
    others = ", ".join([*BLOCK, *[a for a in axes if a != axis]])
    return f"OVER (PARTITION BY {others} ORDER BY {axis})"


def _bare(df: DataFrame, axes, *values) -> DataFrame:
    return df.select("image", *axes, *values, *size_columns(axes))


# --- normalization -----------------------------------------------------------------------


def scaled(v: Column, low: Column, high: Column) -> Column:
    """(v - low) / (high - low) without clipping; a flat range gives 0."""
    return F.when(high == low, F.lit(0.0)).otherwise((v - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low))


def normalize_fixed(df: DataFrame, low: float, high: float) -> DataFrame:
    if low == high:
        raise ValueError("a fixed range needs low < high")
    return df.withColumn("v", (F.col("v") - F.lit(float(low))) / F.lit(float(high) - float(low)))


def normalize_auto(df: DataFrame, scope: str = "block") -> DataFrame:
    """Range from the data: of each block's own pixels, or of each image. Adds ``span``.

    Per block it is a window over one bounded block, which the gather's shuffle satisfies.
    Per image it is an aggregate with map-side partials, joined back: an image is never one group.
    """
    own = F.when(F.col("inside"), F.col("v"))
    if scope == "block":
        w = Window.partitionBy(*BLOCK)
        out = df.withColumns({"v_low": F.min(own).over(w), "v_high": F.max(own).over(w)})
    else:
        out = df.join(df.groupBy("image").agg(F.min(own).alias("v_low"), F.max(own).alias("v_high")), "image")
    out = out.withColumn("v", scaled(F.col("v"), F.col("v_low"), F.col("v_high")))
    return out.withColumn("span", F.col("v_high") - F.col("v_low")).drop("v_low", "v_high")


# --- blur and difference of Gaussians ----------------------------------------------------


def _blurred(df: DataFrame, axes, widths: dict[str, tuple[float, ...]]) -> DataFrame:
    """Adds one blurred column per entry of ``widths``; all share each axis' sort."""
    source = {name: "v" for name in widths}
    for d, axis in enumerate(axes):
        w, new = _along(axes, axis), []
        for name, sigmas in widths.items():
            kernel, c = gauss_weights(sigmas[d]), source[name]
            r = len(kernel) // 2
            taps = [f"{kernel[r]!r}D * {c}"]
            taps += [f"{kernel[r + k]!r}D * (lag({c}, {k}) {w} + lead({c}, {k}) {w})" for k in range(1, r + 1)]
            new.append(f"{' + '.join(taps)} AS {name}")
            source[name] = name
        df = df.selectExpr(*[c for c in df.columns if c not in widths], *new)
    return df


def gauss_smooth(voxels: DataFrame, axes, sigmas, size=None) -> DataFrame:
    """Separable Gaussian blur with kernel radius ceil(3 sigma) and mirrored borders."""
    tiled = blk.tiles(voxels, axes, [radius(s) for s in sigmas], size)
    out = _blurred(tiled, axes, {"blur": tuple(sigmas)}).filter("owned")
    return _bare(out, axes, F.col("blur").alias("v"))


def _with_dog(df: DataFrame, axes, params: SpotParams) -> DataFrame:
    n = len(axes)
    out = _blurred(df, axes, {"g1": params.sigmas(n), "g2": params.sigmas(n, wide=True)})
    return out.withColumn("dog", F.col("g1") - F.col("g2")).drop("g1", "g2")


def dog(voxels: DataFrame, axes, params: SpotParams, size=None) -> DataFrame:
    """Difference of two Gaussians (narrow minus wide), positive at bright spots."""
    tiled = blk.tiles(voxels, axes, [radius(s) for s in params.sigmas(len(axes), wide=True)], size)
    out = _with_dog(tiled, axes, params).filter("owned")
    return _bare(out, axes, "dog")


# --- peaks -------------------------------------------------------------------------------


def _shifted(values: np.ndarray, axis: int, by: int, beyond) -> np.ndarray:
    """Each pixel gets the value ``by`` pixels further along the axis, ``beyond`` outside."""
    out = np.full_like(values, beyond)
    to = [slice(None)] * values.ndim
    from_ = list(to)
    to[axis], from_[axis] = (slice(None, -by), slice(by, None)) if by > 0 else (slice(-by, None), slice(None, by))
    out[tuple(to)] = values[tuple(from_)]
    return out


def _blurred_box(values: np.ndarray, sigmas) -> np.ndarray:
    """As ``_blurred``, in the same order of the sums; right where the kernel lies within the box."""
    for d, sigma in enumerate(sigmas):
        axis, kernel = values.ndim - 1 - d, gauss_weights(sigma)
        r = len(kernel) // 2
        out = kernel[r] * values
        for k in range(1, r + 1):
            out += kernel[r + k] * (_shifted(values, axis, -k, 0.0) + _shifted(values, axis, k, 0.0))
        values = out
    return values


def _spread(null: np.ndarray, reach) -> np.ndarray:
    """Pixels with a null within the reach of a kernel."""
    for d, r in enumerate(reach):
        axis = null.ndim - 1 - d
        null = np.logical_or.reduce([null, *[_shifted(null, axis, by, True) for k in range(1, r + 1) for by in (-k, k)]])
    return null


def _above_neighbours(dog: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Strictly greater than all 3^n - 1 neighbours, one axis at a time; nulls are no neighbours, but some are needed on each axis.

    After each axis ``box`` is the maximum of the box seen so far, so the next axis only has to look one step to either side.
    """
    keep, box = ~null, np.where(null, -np.inf, dog)
    for axis in range(dog.ndim):
        side = np.maximum(_shifted(box, axis, -1, -np.inf), _shifted(box, axis, 1, -np.inf))
        keep &= (dog > side) & (side != -np.inf)
        box = np.maximum(box, side)
    return keep


def dog_peaks(voxels: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Strict local maxima of the normalized image's DoG above the threshold.

    ``voxels`` are raw. Result: ``image, block_id, x, y[, z], dog, span`` plus sizes, where
    ``span`` is the width of the intensity range used. With a fixed range the result does not
    depend on the block size. Pixels near a null are no peaks; pixels of the image without a row are 0.

    Blocks with their halo are packed to arrays before the one shuffle and filtered as arrays, so the pixels move once and aren't sorted.
    """
    n = len(axes)
    reach, block, crop = [radius(s) for s in params.sigmas(n, wide=True)], params.block(n), params.crop(n)
    by_image, given = params.auto_range and params.range_scope == "image", (float(params.min_intensity), float(params.max_intensity))
    if by_image:
        inner = " AND ".join(f"{a} BETWEEN {l} AND {h}" for a, l, h in zip(axes, *blk.bounds(axes, *crop)))
        extent = voxels.filter(inner).groupBy("image").agg(F.min("v").cast("double").alias("v_low"), F.max("v").cast("double").alias("v_high"))
        # Stored, so that its measured size decides how the pixels meet it.
        voxels = voxels.join(written(extent, "extent"), "image")
    gathered = blk.read_by_blocks(voxels, axes, block, reach, *crop, mirrored=crop != (None, None))
    gap = 0.0
    if not params.auto_range:
        gathered, gap = normalize_fixed(gathered, *given), -given[0] / (given[1] - given[0])
    gathered = blk.packed(gathered, axes, block, reach, *crop, beside=("v_low", "v_high") if by_image else ())
    # A given number: blocks are few bytes, but work.
    gathered = gathered.repartition(int(voxels.sparkSession.conf.get("spark.sql.shuffle.partitions")), *BLOCK)
    kinds = dict(gathered.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in BLOCK], *[f"{a} bigint" for a in axes], "dog double", "span double", *[f"{c} {kinds[c]}" for c in size_columns(axes)]])
    arrow = schema_of(schema)

    def run(table: pa.Table) -> pa.Table:
        box = blk.box_of(table, axes, block, reach, *crop, gap=gap)
        low, high = given
        if by_image:
            low, high = table["v_low"][0].as_py(), table["v_high"][0].as_py()
        elif params.auto_range:
            own = box.values[box.inside][~box.null[box.inside]]
            low, high = (float(np.fmin.reduce(own)), float(own.max())) if len(own) else (None, None)
        if low is None or low == high:
            return arrow.empty_table()
        with np.errstate(invalid="ignore", over="ignore"):
            v = (box.values - low) / (high - low) if params.auto_range else box.values
            dog = _blurred_box(v, params.sigmas(n)) - _blurred_box(v, params.sigmas(n, wide=True))
            null = _spread(box.null, reach) if box.null.any() else box.null
            near = tuple(slice(s.start - 1, s.stop + 1) for s in box.owned)
            keep = (_above_neighbours(dog[near], null[near]) & (dog[near] > params.threshold))[(slice(1, -1),) * n]
        at = np.argwhere(keep) + [s.start for s in box.owned]
        places = at[:, ::-1] + np.array(box.start)
        head = lambda c: [table[c][0].as_py()] * len(at)
        columns = [head("image"), head("block_id"), *places.T, dog[tuple(at.T)], [high - low] * len(at), *map(head, size_columns(axes))]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return gathered.groupBy(*BLOCK).applyInArrow(run, schema)


# --- gradients ---------------------------------------------------------------------------


def gradients(voxels: DataFrame, axes, anisotropy: float = 1.0, drop_zero: bool = True, size=None) -> DataFrame:
    """Central differences ``gx, gy[, gz]`` of ``v``; z is scaled by the anisotropy.

    A pixel's neighbours are the rows before and after it on its line, and a null beside it makes a null. As with ``dog_peaks``, blocks are
    packed before the one shuffle, so the pixels move once, and a task sorts the places of one block at a time.
    """
    size, halo = size or blk.TILE[len(axes)], [0] * len(axes)
    gathered = blk.packed(blk.tiled(voxels, axes, [1] * len(axes), size), axes, size, halo, margin=1)
    # A given number: blocks are few bytes, but work.
    gathered = gathered.repartition(int(voxels.sparkSession.conf.get("spark.sql.shuffle.partitions")), *BLOCK)
    kinds = dict(gathered.dtypes)
    schema = ", ".join([f"`image` {kinds['image']}", *[f"{a} bigint" for a in axes], *[f"g{a} double" for a in axes], *[f"{c} {kinds[c]}" for c in size_columns(axes)]])
    arrow = schema_of(schema)
    factors = [float(anisotropy) if a == "z" else 1.0 for a in axes]

    def run(table: pa.Table) -> pa.Table:
        at, taken = blk.places_of(table, size, halo)
        image, *extent = (table[c][0].as_py() for c in ("image", *size_columns(axes)))
        values, null = taken.fill_null(0.0).to_numpy(), taken.is_null().to_numpy(zero_copy_only=False)
        places = [p + s for p, s in zip(at, blk.tile_start(table["block_id"][0].as_py(), extent, size))]
        # The outermost pixels of a block are only read.
        keep = np.logical_and.reduce([(p > 0) & (p < s - 1) & (q < n) for p, q, s, n in zip(at, places, size, extent)])
        slopes = [_slope(values, null, at, d, factor) for d, factor in enumerate(factors)]
        if drop_zero:
            keep &= np.logical_or.reduce([known & (slope != 0) for slope, known in slopes])
        rows = np.flatnonzero(keep)
        head = lambda value: [value] * len(rows)
        found = [pa.array(slope[rows], mask=~known[rows]) for slope, known in slopes]
        columns = [head(image), *[p[rows] for p in places], *found, *map(head, extent)]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return gathered.groupBy(*BLOCK).applyInArrow(run, schema)


def _slope(values: np.ndarray, null: np.ndarray, at: list[np.ndarray], d: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Half the difference of the next and the last row on each row's line along axis ``d``, and where there are both, without a null."""
    order = np.lexsort((at[d], *[p for k, p in enumerate(at) if k != d]))
    slope, known = np.zeros(len(values)), np.zeros(len(values), bool)
    if len(order) > 2:
        last, this, after = order[:-2], order[1:-1], order[2:]
        known[this] = np.logical_and.reduce([p[last] == p[after] for k, p in enumerate(at) if k != d]) & ~null[last] & ~null[after]
        with np.errstate(invalid="ignore", over="ignore"):
            slope[this] = (values[after] - values[last]) / 2.0 * factor
    return slope, known
