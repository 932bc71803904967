import numpy as np
import pytest
from pyspark.sql import functions as F

from punctum.operators import blocks as blk, filters
from punctum.params import AXES
from tests.test_peaks import voxels_of


def by_windows(voxels, axes, anisotropy=1.0, drop_zero=True, size=None):
    """The definition, by windows over the rows of a tile."""
    out, slopes = blk.tiles(voxels, axes, [1] * len(axes), size), []
    for a in axes:
        w = f"OVER (PARTITION BY image, block_id, {', '.join(b for b in axes if b != a)} ORDER BY {a})"
        slopes.append(f"(lead(v, 1) {w} - lag(v, 1) {w}) / 2.0D{f' * {anisotropy}D' if a == 'z' else ''} AS g{a}")
    out = out.selectExpr("*", *slopes).filter("owned")
    if drop_zero:
        out = out.filter(" OR ".join(f"g{a} <> 0" for a in axes))
    return out.select("image", *axes, *["g" + a for a in axes], *["n" + a for a in axes])


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def odd_voxels(spark, shape):
    """Nulls and NaN, pixels without a row, rows that come twice, images of other sizes (one pixel wide too), a null name."""
    axes, draw = AXES[len(shape)], np.random.default_rng(len(shape))
    image = draw.poisson(1.2, shape).astype(float)
    whole = voxels_of(spark, image).filter("pmod(hash({}), 11) <> 0".format(", ".join(axes)))
    odd = whole.withColumn("v", F.when(F.expr("pmod(hash(x, y), 13) = 0"), F.lit(None)).when(F.expr("pmod(hash(y, x), 17) = 0"), F.lit(float("nan"))).otherwise(F.col("v")))
    twice = odd.filter("x = 2").withColumn("image", F.lit("i"))
    thin = voxels_of(spark, image[..., :1]).withColumn("image", F.lit("thin"))
    return odd.union(twice).union(thin).union(whole.withColumn("image", F.lit(None).cast("string")))


@pytest.mark.parametrize("shape, size", [((41, 50), (16, 13)), ((41, 50), None), ((14, 23, 30), (12, 11, 9)), ((3, 9, 30), (17, 9, 3)), ((2, 1, 5), None)])
@pytest.mark.parametrize("drop_zero", [True, False])
def test_gradients_equal_windows_over_the_rows(spark, shape, size, drop_zero):
    axes, voxels = AXES[len(shape)], odd_voxels(spark, shape)
    got = filters.gradients(voxels, axes, 0.7, drop_zero, size)
    want = by_windows(voxels, axes, 0.7, drop_zero, size)
    assert got.dtypes == want.dtypes
    assert rows_of(got) == rows_of(want) and got.count() > 0


def test_gradients_of_no_rows(spark):
    assert filters.gradients(voxels_of(spark, np.zeros((3, 3))).limit(0), AXES[2]).count() == 0


def test_pixels_move_once_and_are_not_sorted(spark):
    """A row is a part of a block, also if the name of the image is a constant."""
    plan = filters.gradients(voxels_of(spark, np.zeros((12, 20, 30))), AXES[3], 0.7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange hashpartitioning") < plan.index("MapInArrow ")
