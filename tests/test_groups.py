import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctum.operators import detect
from punctum.params import AXES, NO_RANSAC, SpotParams, gauss_weights
from punctum.sources import images as img
from punctum.streaming import outputs
from tests.test_sources import chunk_rows

SMALL = SpotParams(max_intensity=9.0, ransac=NO_RANSAC, threshold=0.01, block_size=(13, 11))


def images(shape, names):
    return {n: np.random.default_rng(k).poisson(1.2, shape).astype(float) for k, n in enumerate(names)}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("scope", ["block", "image"])
def test_spots_do_not_depend_on_how_many_blocks_share_a_group(spark, monkeypatch, scope):
    dims, axes = (50, 41), AXES[2]
    chunks = chunk_rows(spark, images(dims[::-1], ["a", "b", "c+%1"]), dims, (16, 16), drop={("b", 4)}).repartition(5)
    found = []
    for together in (1, 3, 8):
        monkeypatch.setattr(detect, "BLOCKS_PER_GROUP", together)
        for p in (SMALL, SMALL.with_(max_intensity=0.0, range_scope=scope)):
            spots = detect.detect(chunks, axes, p)
            found.append(sorted(map(str, spots.select(*sorted(spots.columns)).collect())))
    assert len(found[0]) > 20 and found[0::2] == [found[0]] * 3 and found[1::2] == [found[1]] * 3


def test_small_blocks_share_a_group_and_large_ones_do_not(spark):
    dims, axes = (50, 41), AXES[2]
    chunks = chunk_rows(spark, images(dims[::-1], ["a"]), dims, (16, 16))
    plan = lambda p: plan_of(detect.block_candidates(detect.chunk_gather(chunks, axes, p), axes, p)).split("FlatMapGroupsInArrow", 1)[1].split("]")[0]
    assert "part" in plan(SMALL) and "block_id" not in plan(SMALL)
    assert "block_id" in plan(SMALL.with_(block_size=None)) and "part" not in plan(SMALL.with_(block_size=None))


@pytest.mark.parametrize("shape, halo", [((30, 41), (6, 6)), ((19, 25, 30), (6, 5, 6)), ((11, 30), (6, 6)), ((13, 12), (6, 6))])
def test_blurred_pixels_are_those_of_the_whole_array(shape, halo):
    v, sigmas = np.random.default_rng(3).normal(size=shape), (1.5, 1.2, 1.7)[: len(shape)]
    whole = v
    for d, sigma in enumerate(sigmas):
        kernel = np.array(gauss_weights(sigma))
        whole = np.apply_along_axis(lambda line: np.convolve(np.pad(line, len(kernel) // 2), kernel, "valid"), len(shape) - 1 - d, whole)
    own = tuple(slice(r, max(r, n - r)) for r, n in zip(halo[::-1], shape))
    got = detect._blur(v, sigmas, halo)
    assert got.shape == whole[own].shape and np.allclose(got, whole[own], atol=1e-12)


def test_arrivals_take_sizes_from_the_new_files(spark, tmp_path, monkeypatch):
    """No pass over all chunks of the images that changed; finished images may be left alone; rows of no image are no spots."""
    def unwanted(*_):
        raise AssertionError("read for sizes")

    monkeypatch.setattr(detect, "stored_size", unwanted)
    dims, axes, (source, target, state) = (50, 41), AXES[2], (str(tmp_path / n) for n in ("in", "out", "state"))
    arrays = images(dims[::-1], ["a b", "c/d%1"])
    chunks = chunk_rows(spark, arrays, dims, (16, 16)).drop("x1", "y1")
    run = lambda **options: outputs.detect_arrivals(spark, source, axes, SMALL, target, state, **options).awaitTermination()
    found = lambda: sorted((r.image, r.sx, r.sy) for r in outputs.arrived(spark, target, axes).collect())
    want = lambda table: sorted((r.image, r.sx, r.sy) for r in detect.detect(table, axes, SMALL, img.footer_size(spark, source, axes)).collect())
    early = chunks.filter("chunk_id < 5")
    img.write_images(early, source)
    img.write_images(early.filter("image = 'a b'").withColumn("image", F.lit(None).cast("string")), source, mode="append")
    run()
    first = found()
    assert first == want(early) and {n for n, *_ in first} == set(arrays)
    img.write_images(chunks.filter("chunk_id >= 5 AND image = 'a b'"), source, mode="append")
    run(skip_finished=True)
    assert found() == first
    img.write_images(chunks.filter("chunk_id >= 5 AND image <> 'a b'"), source, mode="append")
    run()
    assert found() == want(chunks.filter("chunk_id < 5 OR image <> 'a b'"))
    assert len(os.listdir(f"{target}/images")) == 3
