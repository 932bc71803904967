"""Intensity of localized spots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctum.functions import geometry as geo


def spot_intensity(spots: DataFrame, voxels: DataFrame, axes) -> DataFrame:
    """Adds ``intensity``: v interpolated n-linearly at the sub-pixel position.

    Each spot explodes to its 2^n corners (mirrored at the border) and fetches them with an equi-join.
    ``spots`` carry the image size; one candidate may own several spots, told apart by ``round``.
    """
    pixels = voxels.select("image", *[F.col(a).alias("c" + a) for a in axes], "v")
    joined = corners(spots, axes).join(pixels, ["image", *["c" + a for a in axes]])
    return joined.groupBy(*spots.columns).agg(F.sum(F.col("weight") * F.col("v")).alias("intensity"))


def corners(spots: DataFrame, axes) -> DataFrame:
    """The 2^n pixels around each spot as ``cx, cy[, cz]`` with their weights."""
    out = spots.withColumn("weight", F.lit(1.0))
    for a in axes:
        low, n = f"floor({a})", "n" + a
        pair = f"array(struct({geo.mirror(low, n)} AS at, 1 - ({a} - {low}) AS w), struct({geo.mirror(f'({low} + 1)', n)} AS at, {a} - {low} AS w))"
        others = [c for c in out.columns if c != "weight"]
        out = out.selectExpr("*", f"explode({pair}) AS c").selectExpr(*others, "weight * c.w AS weight", f"c.at AS c{a}")
    return out


def chunk_intensity(spots: DataFrame, chunks: DataFrame, axes) -> DataFrame:
    """``spot_intensity`` on chunk rows: each corner meets its chunk by image and place in the image's chunk grid.

    A pixel of a missing chunk is 0.
    """
    grid = chunks.groupBy("image").agg(*[F.max("w" + a).alias("g" + a) for a in axes])
    at = corners(spots, axes).join(grid, "image").selectExpr("*", *[f"c{a} div g{a} AS k{a}" for a in axes])
    cells = chunks.join(grid, "image").selectExpr("image", *[f"{a}0 div g{a} AS k{a}" for a in axes], *[f"{a}0 AS o{a}" for a in axes], *[f"w{a} AS e{a}" for a in axes], "data")
    place, stride = [], "1"
    for a in axes:
        place.append(f"(c{a} - o{a}) * {stride}")
        stride += f" * e{a}"
    met = at.join(cells, ["image", *["k" + a for a in axes]], "left")
    value = F.expr(f"coalesce(get(data, CAST({' + '.join(place)} AS INT)), 0.0F)").cast("double")
    return met.groupBy(*spots.columns).agg(F.sum(F.col("weight") * value).alias("intensity"))


def intensity_threshold(spots: DataFrame, least: float) -> DataFrame:
    return spots.filter(F.col("intensity") >= F.lit(float(least)))
