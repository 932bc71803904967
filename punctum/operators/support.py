"""Support regions of candidates and background subtraction on their gradients.

Rows carry the candidate position as ``sx, sy[, sz]``, the gradient's offset from it as
``dx, dy[, dz]`` and its components ``gx, gy[, gz]``. A region has at most (2r+1)^n rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from punctum.functions.numeric import SLACK
from punctum.params import BG_MEAN, BG_MEDIAN, BG_NONE, BG_RANSAC_MEAN, BG_RANSAC_MEDIAN


def spot_key(axes) -> list[str]:
    return ["image", *["s" + a for a in axes]]


def support_region(candidates: DataFrame, gradients: DataFrame, axes, r: int) -> DataFrame:
    """Gradients in the cube of radius r around each candidate; pixels beyond the image are no members.

    The cube is bounded, so each candidate explodes to its positions and an equi-join fetches them.
    Where candidates carry ``span``, raw gradients are scaled to the candidate's intensity range.
    """
    span = F.col("span") if "span" in candidates.columns else F.lit(1.0)
    spots = candidates.select("image", *[F.col(a).alias("s" + a) for a in axes], span.alias("span"))
    for a in axes:
        spots = spots.withColumn("d" + a, F.explode(F.sequence(F.lit(-r), F.lit(r))))
    at = spots.select("*", *[(F.col("s" + a) + F.col("d" + a)).alias(a) for a in axes])
    joined = at.join(gradients.select("image", *axes, *["g" + a for a in axes]), ["image", *axes])
    return joined.select(*spot_key(axes), *["d" + a for a in axes], *[(F.col("g" + a) / F.col("span")).alias("g" + a) for a in axes])


def shell(axes, r: int) -> Column:
    return reduce(lambda c, a: c | (F.abs("d" + a) == r), axes[1:], F.abs("d" + axes[0]) == r)


def background(region: DataFrame, axes, r: int, method: int, max_error: float = 0.05, min_ratio: float = 0.75) -> DataFrame:
    """Per spot ``bgx, bgy[, bgz]``: the background gradient, estimated on the region's outer shell."""
    outer = region.filter(shell(axes, r))
    key = spot_key(axes)
    if method == BG_MEAN:
        return outer.groupBy(*key).agg(*[F.avg("g" + a).alias("bg" + a) for a in axes])
    if method == BG_MEDIAN:
        return outer.groupBy(*key).agg(*[F.median("g" + a).alias("bg" + a) for a in axes])
    if method not in (BG_RANSAC_MEAN, BG_RANSAC_MEDIAN):
        raise ValueError(f"unknown background method {method}")
    return _consensus(outer, axes, method, max_error, min_ratio)


def _consensus(outer: DataFrame, axes, method: int, max_error: float, min_ratio: float) -> DataFrame:
    """Mean or median of the largest set of values within ``max_error`` of one of them, per axis.

    Every value is tried, so nothing is sampled; ties go to the smallest value; too small a set gives 0.
    A range frame counts each value's neighbours; all windows share one shuffle by (spot, axis).
    """
    key, limit = spot_key(axes), max_error + SLACK
    each = outer.select(*key, F.inline(F.array(*[F.struct(F.lit(a).alias("axis"), F.col("g" + a).alias("g")) for a in axes])))
    whole = f"PARTITION BY {', '.join(key)}, axis"
    ranked = each.selectExpr(
        "*", f"count(*) OVER ({whole} ORDER BY g RANGE BETWEEN {limit!r}D PRECEDING AND {limit!r}D FOLLOWING) AS near",
        f"count(*) OVER ({whole}) AS size")
    ranked = ranked.selectExpr("*", f"-(max(struct(near, -g AS h)) OVER ({whole})).h AS best")
    members = ranked.filter(F.abs(F.col("g") - F.col("best")) <= limit)
    middle = F.avg("g") if method == BG_RANSAC_MEAN else F.median("g")
    level = members.groupBy(*key, "axis").agg(
        F.when(F.count("*") >= F.lit(min_ratio) * F.max("size"), middle).otherwise(F.lit(0.0)).alias("level"))
    return level.groupBy(*key).agg(*[F.max(F.when(F.col("axis") == a, F.col("level"))).alias("bg" + a) for a in axes])


def subtract_background(region: DataFrame, axes, r: int, method: int, max_error: float = 0.05, min_ratio: float = 0.75) -> DataFrame:
    if method == BG_NONE:
        return region
    level = background(region, axes, r, method, max_error, min_ratio)
    out = region.join(level, spot_key(axes), "left")
    return out.select(
        *spot_key(axes), *["d" + a for a in axes],
        *[(F.col("g" + a) - F.coalesce(F.col("bg" + a), F.lit(0.0))).alias("g" + a) for a in axes],
    )
