import numpy as np
import pytest
from pyspark.sql import functions as F

from punctum.functions import geometry as geo
from punctum.operators import blocks as blk
from punctum.params import AXES, SpotParams


def sizes(spark, *dims):
    axes = AXES[len(dims)]
    return spark.range(1).select(F.lit("i").alias("image"), *[F.lit(n).cast("bigint").alias("n" + a) for a, n in zip(axes, dims)])


@pytest.mark.parametrize("dims,block,expected", [((150, 90, 40), (50, 32, 22), 24), ((2, 50), (16, 16), 0), ((3, 3), (3, 3), 1)])
def test_number_of_blocks(spark, dims, block, expected):
    assert blk.split_blocks(sizes(spark, *dims), AXES[len(dims)], block).count() == expected


def test_blocks_of_a_crop_with_negative_bounds(spark):
    out = blk.split_blocks(sizes(spark, 900, 900), AXES[2], (42, 32), (7, -11), (160, 40)).orderBy("block_id").collect()
    assert len(out) == 8 and out[1].x_min == 47 and out[0].y_max == 20 and out[7].x_max == 160 and out[7].y_max == 40


def test_interiors_cover_once(spark):
    v = spark.range(40).selectExpr("'i' image", "id x", "explode(sequence(0L, 16L)) y", "40L nx", "17L ny")
    for block in ((5, 4), (3, 3), (40, 17), (64, 64)):
        out = blk.read_by_blocks(v, AXES[2], block, (2, 2)).filter("owned").groupBy("x", "y").count().collect()
        assert sorted((r.x, r.y, r["count"]) for r in out) == [(x, y, 1) for x in range(1, 39) for y in range(1, 16)]


def test_tiny_blocks_raise(spark):
    with pytest.raises(ValueError):
        SpotParams(block_size=(2, 16))
    with pytest.raises(ValueError):
        geo.block_count("0L", "9L", 2)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_mirror_equals_reflect_padding(spark, n):
    got = [r.m for r in spark.range(41).selectExpr(f"{geo.mirror('(id - 20)', f'{n}L')} AS m").collect()]
    assert got == list(np.pad(np.arange(n), 20, mode="reflect")[: 41] if n > 1 else np.zeros(41, int))


@pytest.mark.parametrize("n,reach", [(1, 2), (2, 5), (5, 3), (9, 20)])
def test_mirror_images_invert_mirror(spark, n, reach):
    rows = spark.range(n).selectExpr("id p", f"explode({geo.mirror_images('id', f'{n}L', reach)}) AS q").filter("q IS NOT NULL").collect()
    assert sorted(r.q for r in rows) == list(range(-reach, n + reach))
    padded = np.pad(np.arange(n), reach, mode="reflect") if n > 1 else np.zeros(2 * reach + 1, int)
    assert all(padded[r.q + reach] == r.p for r in rows)


def test_parse_int_list_raises_on_bad_input(spark):
    row = spark.range(1)
    assert row.select(geo.parse_int_list(F.lit("128,128,64"), 3).alias("v")).first().v == [128, 128, 64]
    for text in ("1,2", "1,b,3", "1,2,"):
        with pytest.raises(Exception, match="not a list of"):
            row.select(geo.parse_int_list(F.lit(text), 3).alias("v")).collect()
