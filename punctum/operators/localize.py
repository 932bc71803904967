"""Sub-pixel centres by radial symmetry.

A gradient at offset p with unit direction g defines a line through the centre. The centre
minimizes the summed squared distance to all lines: A = sum(I - g g'), b = sum((I - g g') p).
z offsets count 1/anisotropy. Gradients of norm <= 1e-9 have no direction and are dropped;
a singular system (|det| < 1e-9) gives no centre; a centre farther than ``max_shift``, if that is
set, from its candidate on any axis is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctum.functions.arrow import schema_of
from punctum.functions.numeric import SLACK, ZERO_NORM, solve, total
from punctum.operators import batched
from punctum.operators.support import spot_key
from punctum.params import MULTICONSENSUS, NO_RANSAC, SpotParams
from punctum.session import written


def scale(axes, anisotropy: float) -> list[float]:
    return [1.0 / anisotropy if a == "z" else 1.0 for a in axes]


def lsq(region: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Least squares over all gradients: plain sums with map-side partials, solved in closed form."""
    n = range(len(axes))
    norm = F.sqrt(total([F.col("g" + a) * F.col("g" + a) for a in axes]))
    rows = region.withColumn("norm", norm).filter(F.col("norm") > ZERO_NORM)
    g = [F.col("g" + a) / F.col("norm") for a in axes]
    p = [F.col("d" + a) * F.lit(s) for a, s in zip(axes, scale(axes, params.anisotropy))]
    m = {(i, j): (F.lit(1.0 if i == j else 0.0) - g[i] * g[j]) for i in n for j in n if i <= j}
    sums = [F.sum(e).alias(f"m{i}{j}") for (i, j), e in m.items()]
    sums += [F.sum(total([m[(min(i, j), max(i, j))] * p[j] for j in n])).alias(f"r{i}") for i in n]
    fitted = rows.groupBy(*spot_key(axes)).agg(F.count("*").alias("n"), *sums)
    _, centre = solve({k: F.col(f"m{k[0]}{k[1]}") for k in m}, [F.col(f"r{i}") for i in n])
    offset = [c / F.lit(s) for c, s in zip(centre, scale(axes, params.anisotropy))]
    if params.max_shift is not None:
        fitted = fitted.filter(reduce(lambda a, b: a & b, [F.abs(o) <= params.max_shift for o in offset]))
    return fitted.select(
        *spot_key(axes), *[(F.col("s" + a) + o).alias(a) for a, o in zip(axes, offset)],
        F.col("n").alias("gradients"), F.col("n").alias("inliers"), F.lit(0).cast("bigint").alias("round"),
    )


def regions_as_rows(region: DataFrame, axes) -> DataFrame:
    """One row per spot with its gradients ordered by position; bounded by the support radius."""
    entry = F.struct(*["d" + a for a in axes], *["g" + a for a in axes])
    packed = region.groupBy(*spot_key(axes)).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    fields = [*["d" + a for a in axes], *["g" + a for a in axes]]
    return packed.select(*spot_key(axes), *[F.col(f"e.{f}").cast("array<double>").alias(f) for f in fields])


def result_schema(axes) -> str:
    return ", ".join(
        ["image string", *[f"s{a} bigint" for a in axes], *[f"{a} double" for a in axes],
         "gradients bigint", "inliers bigint", "round bigint"]
    )


def fit_rows(spots: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Localize spot rows (``regions_as_rows``) with the method the settings name."""

    schema, stretch = schema_of(result_schema(axes)), np.array(scale(axes, params.anisotropy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = lambda prefix: batched.padded([batch.column(prefix + a) for a in axes])
            at = np.stack([batch.column("s" + a).to_numpy() for a in axes], axis=1)
            (p, mask), (g, _) = lists("d"), lists("g")
            found = batched.fit(batch.column("image").to_pylist(), at, p, g, mask, stretch, params)
            yield fits_batch(batch.column("image"), at, found, schema)

    fitted = spots.mapInArrow(run, result_schema(axes))
    return drop_weak_counts(written(fitted, "centres"), params) if params.ransac == MULTICONSENSUS else fitted


def fits_batch(images: pa.Array, at: np.ndarray, found: batched.Fits, schema: pa.Schema) -> pa.RecordBatch:
    """``image``, candidate, centre, gradients, inliers and round of each fit."""
    place = at[found.spot]
    columns = [images.take(pa.array(found.spot)), *place.T, *(place + found.centre).T, found.gradients, found.inliers, found.round]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def drop_weak_counts(spots: DataFrame, params: SpotParams) -> DataFrame:
    """Drop spots with fewer inliers than avg - n * stdev of their image, twice (n1, then n2).

    Both limits come from one histogram with at most a row per image and number of inliers; ``spots`` is a
    stored table, so the detection runs once.
    """
    counts = spots.groupBy("image", "inliers").agg(F.count("*").alias("spots"))
    least = None
    for n in (params.n_stdev1, params.n_stdev2):
        weight, value = F.sum("spots"), F.col("inliers").cast("double")
        mean = F.sum(value * F.col("spots")) / weight
        spread = F.sqrt(F.greatest(F.lit(0.0), F.sum(value * value * F.col("spots")) / weight - mean * mean))
        # Integers divide almost exactly; the slack keeps a count that equals its limit.
        limit = counts.groupBy("image").agg((mean - F.lit(float(n)) * spread - F.lit(SLACK)).alias("limit"))
        counts = counts.join(limit, "image").filter(F.col("inliers") >= F.col("limit")).drop("limit")
        least = counts.groupBy("image").agg(F.min("inliers").alias("least"))
    return spots.join(least, "image").filter(F.col("inliers") >= F.col("least")).drop("least")


def localize(region: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Centres of all candidates from their support regions."""
    if params.ransac == NO_RANSAC:
        return lsq(region, axes, params)
    return fit_rows(regions_as_rows(region, axes), axes, params)
