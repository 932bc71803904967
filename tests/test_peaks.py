import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctum.operators import detect, filters
from punctum.params import AXES, SpotParams, gauss_weights
from punctum.sources import images as img

FIXED = SpotParams(min_intensity=-1.0, max_intensity=9.0, threshold=0.01, anisotropy=0.7)


def voxels_of(spark, image: np.ndarray):
    """One row per pixel of an array whose last axis is x; the name of the image is a constant, as it is for one large image."""
    axes = AXES[image.ndim]
    rows = [(*map(int, at[::-1]), None if np.isnan(v) else float(v)) for at, v in np.ndenumerate(image)]
    frame = spark.createDataFrame(rows, ", ".join(f"{a} bigint" for a in axes) + ", v double").repartition(3)
    return frame.select(F.lit("i").alias("image"), *axes, "v", *[F.lit(n).cast("bigint").alias("n" + a) for a, n in zip(axes, image.shape[::-1])])


def blurred(v, sigmas):
    for d, sigma in enumerate(sigmas):
        axis, kernel = v.ndim - 1 - d, np.array(gauss_weights(sigma))
        r = len(kernel) // 2
        v = np.apply_along_axis(lambda line: np.convolve(np.pad(line, r, mode="reflect"), kernel, "valid"), axis, v)
    return v


def brute(image, p):
    """Peaks of the whole image, without blocks; pixels near a null are neither peaks nor neighbours."""
    n, v = image.ndim, (image - p.min_intensity) / (p.max_intensity - p.min_intensity)
    dog = blurred(v, p.sigmas(n)) - blurred(v, p.sigmas(n, wide=True))
    found = {}
    for at in itertools.product(*[range(1, s - 1) for s in image.shape]):
        near = dog[tuple(slice(a - 1, a + 2) for a in at)]
        if dog[at] > p.threshold and np.sum(near >= dog[at]) == 1:
            found[at[::-1]] = dog[at]
    return found


def peaks(frame, axes):
    return {tuple(r[a] for a in axes): r.dog for r in frame.collect()}


@pytest.mark.parametrize("shape, block", [((41, 50), (16, 13)), ((41, 50), None), ((14, 23, 30), (12, 11, 9)), ((4, 14, 60), (17, 9, 3))])
def test_peaks_equal_those_of_the_whole_image(spark, shape, block):
    image, axes = np.random.default_rng(len(shape)).poisson(1.2, shape).astype(float), AXES[len(shape)]
    p = FIXED.with_(block_size=block, threshold=-1.0)
    rows = filters.dog_peaks(voxels_of(spark, image), axes, p)
    got, want = peaks(rows, axes), brute(image, p)
    assert rows.count() == len(got) == len(want) > 0 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {r.span for r in rows.collect()} == {10.0}


def test_pixels_move_once_and_are_not_sorted(spark):
    """A row is a part of a block, also if the name of the image is a constant."""
    frame = filters.dog_peaks(voxels_of(spark, np.zeros((12, 20, 30))), AXES[3], FIXED.with_(block_size=(12, 11, 9)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange hashpartitioning") < plan.index("MapInArrow ")


@pytest.mark.parametrize("shape, block", [((41, 50), (16, 13)), ((14, 23, 30), (12, 11, 9))])
def test_nulls_and_missing_pixels(spark, shape, block):
    image, axes, p = np.random.default_rng(8).poisson(1.2, shape).astype(float), AXES[len(shape)], FIXED.with_(block_size=block)
    image[(7,) * len(shape)] = np.nan
    got, want = peaks(filters.dog_peaks(voxels_of(spark, image), axes, p), axes), brute(image, p)
    # Beside the pixels near the null some have no neighbour on an axis, or fewer to be greater than.
    edge = lambda at: max(abs(a - 7) for a in at) <= 8
    assert {k for k in got if not edge(k)} == {k for k in want if not edge(k)} and len(got) > 0
    assert all(max(abs(a - 7) for a in at) > 4 for at in got)
    image[(7,) * len(shape)] = 0.0
    gone = voxels_of(spark, image).filter("NOT (" + " AND ".join(f"{a} = 7" for a in axes) + ")").filter("v <> 0")
    assert peaks(filters.dog_peaks(gone, axes, p), axes).keys() == brute(image, p).keys()


@pytest.mark.parametrize("scope", ["block", "image"])
def test_ranges_from_the_data_and_crops(spark, scope):
    """As found in arrays of chunks."""
    image = np.random.default_rng(5).poisson(1.2, (41, 50)).astype(float)
    voxels = voxels_of(spark, image)
    two = voxels.union(voxels.withColumns({"image": F.lit("j"), "v": F.col("v") * F.when(F.col("x") < 20, 3.0).otherwise(1.0)}))
    chunks = img.chunk_table(two.select("image", "x", "y", "v"), AXES[2], (50, 41), (16, 16))
    for changes in ({}, dict(crop_min=(6, 5), crop_max=(40, 33))):
        p = SpotParams(threshold=0.01, range_scope=scope, block_size=(16, 13), **changes)
        key = lambda frame: {(r.image, r.block_id, r.x, r.y): (r.dog, r.span) for r in frame.collect()}
        got, want = key(filters.dog_peaks(two, AXES[2], p)), key(detect.block_candidates(detect.chunk_gather(chunks, AXES[2], p), AXES[2], p))
        assert got.keys() == want.keys() and len(got) > 10
        assert all(np.allclose(got[k], want[k], atol=1e-9) for k in want)
