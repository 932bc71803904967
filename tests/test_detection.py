import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctum.operators import compare, detect, filters
from punctum.params import AXES, MULTICONSENSUS, NO_RANSAC, SpotParams
from punctum.plans import spots as chain
from punctum.sources import images as img

FIXED = SpotParams(max_intensity=100.0, ransac=NO_RANSAC, threshold=0.02)


def spots_image(spark, dims, centres, anisotropy=1.0, sigma=1.5, chunk=None):
    axes = AXES[len(dims)]
    grid = np.stack(np.meshgrid(*[np.arange(n) for n in dims], indexing="ij"), axis=-1).reshape(-1, len(dims))
    width = np.array([sigma * (anisotropy if a == "z" else 1.0) for a in axes])
    v = sum(100.0 * np.exp(-(((grid - c) / width) ** 2).sum(axis=1) / 2) for c in np.array(centres, float)) if centres else np.zeros(len(grid))
    cells = [(("i"), *map(int, p), float(value)) for p, value in zip(grid, v) if value > 1e-6]
    schema = "image string, " + ", ".join(f"{a} bigint" for a in axes) + ", v double"
    return img.chunk_table(spark.createDataFrame(cells, schema), axes, dims, chunk or (16,) * len(dims))


def found(df, axes):
    return sorted(tuple(r[a] for a in axes) for r in df.collect())


CENTRES2 = [(12.3, 15.7), (30.0, 18.4), (47.6, 50.2), (15.4, 44.1), (32.6, 33.2)]
CENTRES3 = [(8.2, 9.6, 7.3), (22.4, 21.7, 14.6)]


@pytest.mark.parametrize("ransac", [NO_RANSAC, 1, MULTICONSENSUS])
def test_ground_truth_2d(spark, ransac):
    p = FIXED.with_(ransac=ransac, block_size=(24, 24), min_inliers=15)
    got = found(detect.detect(spots_image(spark, (64, 64), CENTRES2), AXES[2], p), AXES[2])
    assert len(got) == len(CENTRES2)
    assert np.abs(np.array(got) - np.array(sorted(CENTRES2))).max() < 0.1


@pytest.mark.parametrize("anisotropy", [1.0, 0.7])
def test_ground_truth_3d(spark, anisotropy):
    p = FIXED.with_(anisotropy=anisotropy, block_size=(20, 20, 14))
    got = found(detect.detect(spots_image(spark, (32, 32, 24), CENTRES3, anisotropy), AXES[3], p), AXES[3])
    assert len(got) == 2 and np.abs(np.array(got) - np.array(CENTRES3)).max() < 0.15


def test_result_does_not_depend_on_blocks_or_path(spark):
    chunks = spots_image(spark, (64, 64), CENTRES2)
    whole = found(detect.detect(chunks, AXES[2], FIXED.with_(block_size=(64, 64), ransac=1)), AXES[2])
    for block in ((16, 16), (23, 11)):
        got = found(detect.detect(chunks.repartition(3), AXES[2], FIXED.with_(block_size=block, ransac=1)), AXES[2])
        assert np.abs(np.array(got) - np.array(whole)).max() < 1e-9
    dense = img.chunk_table(img.voxels_of_chunks(chunks, AXES[2]).select("image", "x", "y", "v"), AXES[2], (64, 64), (16, 16), chunks.select("image").distinct())
    rel = found(chain.detect_voxels(img.voxels_of_chunks(dense, AXES[2]), AXES[2], FIXED.with_(ransac=1, block_size=(23, 11))), AXES[2])
    assert np.abs(np.array(rel) - np.array(whole)).max() < 1e-5


def test_auto_range_depends_on_blocks_but_not_in_image_scope(spark):
    chunks = spots_image(spark, (64, 64), CENTRES2)
    auto = SpotParams(ransac=NO_RANSAC, range_scope="image", threshold=0.02)
    a = found(detect.detect(chunks, AXES[2], auto.with_(block_size=(16, 16))), AXES[2])
    b = found(detect.detect(chunks, AXES[2], auto.with_(block_size=(64, 64))), AXES[2])
    assert len(a) == len(b) == 5 and np.allclose(a, b)
    per_block = [detect.block_candidates(detect.chunk_gather(chunks, AXES[2], auto.with_(range_scope="block", block_size=s)), AXES[2], auto.with_(range_scope="block", block_size=s)).agg(F.min("span")).first()[0] for s in ((16, 16), (64, 64))]
    assert per_block[0] < per_block[1]


def test_spot_on_a_seam_is_found_once(spark):
    chunks = spots_image(spark, (40, 40), [(15.0, 14.0), (29.2, 28.1)])
    for block in ((16, 16), (17, 16), (18, 31)):
        assert detect.detect(chunks, AXES[2], FIXED.with_(block_size=block)).count() == 2


def test_crop_reads_beyond_its_bounds(spark):
    chunks = spots_image(spark, (64, 64), CENTRES2)
    p = FIXED.with_(block_size=(16, 16), crop_min=(11, 14), crop_max=(31, 34))
    assert [tuple(round(c) for c in s) for s in found(detect.detect(chunks, AXES[2], p), AXES[2])] == [(12, 16), (30, 18)]


def test_empty_flat_and_plateau_images(spark):
    empty = spots_image(spark, (32, 32), [])
    assert detect.detect(empty, AXES[2], FIXED.with_(block_size=(16, 16))).count() == 0
    # Two equal neighbours: neither is strictly greater, so the plateau gives no spot.
    flat = spark.range(32).selectExpr("'i' image", "id x", "explode(sequence(0L, 31L)) y")
    flat = flat.selectExpr("*", "CASE WHEN x IN (15, 16) AND y = 10 THEN 50.0D ELSE 0.0D END v", "32L nx", "32L ny")
    assert filters.dog_peaks(flat, AXES[2], FIXED.with_(block_size=(16, 16))).count() == 0


def brute(a, b):
    return {i: min((math.hypot(x - u, y - w), j) for j, u, w in b) for i, x, y in a}


@pytest.mark.parametrize("spread", [1.0, 1e-4])
def test_nearest_equals_brute_force(spark, spread):
    rng = np.random.default_rng(3)
    far = [(i, *map(float, rng.random(2) * 50)) for i in range(60)]
    dense = [(100 + i, *map(float, 20 + spread * rng.random(2))) for i in range(200)]
    copies = [(500 + i, 7.0, 7.0) for i in range(30)]
    a = far[:30] + dense[:100] + copies[:10] + [(900, 500.0, -300.0)]
    b = far[30:] + dense[100:] + copies[10:]
    schema = "id bigint, x double, y double"
    got = {r.id: (r.distance, r.match_id) for r in compare.nearest(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), AXES[2]).collect()}
    want = brute(a, b)
    assert got.keys() == want.keys()
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-9 for k in want)
    left = compare.unmatched(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), AXES[2], 0.5)
    assert sorted(r.id for r in left.collect()) == sorted(k for k, (d, _) in want.items() if d >= 0.5)


@pytest.mark.parametrize("dims, chunk", [((64, 60), (16, 16)), ((50, 41), (24, 7)), ((26, 24, 20), (16, 10, 8))])
def test_chunks_in_place_give_the_same_spots(spark, tmp_path, dims, chunk):
    axes, n = AXES[len(dims)], len(dims)
    centres = {2: [(12.3, 15.7), (30.0, 18.4), (15.4, 36.1), (32.6, 33.2), (44.5, 8.2)], 3: CENTRES3[:1] + [(17.0, 15.6, 12.3)]}[n]
    chunks = spots_image(spark, dims, centres, chunk=chunk).filter("chunk_id % 5 <> 3")  # missing chunks are zero
    table = img.write_bucketed(chunks, f"buckets_{n}_{dims[0]}", str(tmp_path / "buckets"), axes, 4)
    crop = dict(crop_min=(6, 5, 3)[:n], crop_max=(40, 33, 16)[:n])
    image = dict(min_intensity=0.0, max_intensity=0.0, range_scope="image")
    for changes in ({}, crop if n == 2 else {"ransac": 1}, image, {**image, **crop} if n == 2 else {"max_shift": 2.0}):
        p = FIXED.with_(**changes)
        key = lambda df: sorted(tuple(r[c] for c in ["image", *["s" + a for a in axes], *axes, "intensity"]) for r in df.collect())
        want, got = key(detect.detect(chunks, axes, p.with_(block_size=dims))), key(chain.detect_in_place(table, axes, p, chunk))
        assert want and len(got) == len(want)
        assert np.abs(np.array([w[1:] for w in want]) - np.array([g[1:] for g in got])).max() < 1e-6


def test_chunks_in_place_do_not_move(spark, tmp_path):
    table = img.write_bucketed(spots_image(spark, (64, 64), CENTRES2), "buckets_still", str(tmp_path / "still"), AXES[2], 4)
    p = FIXED.with_(max_shift=1.0)
    gather = detect.in_place_gather(table, AXES[2], p, (16, 16))
    plan = detect.spots_of(gather, AXES[2], p)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 1
    assert plan.index("FlatMapCoGroupsInArrow") < plan.index("Exchange hashpartitioning")


def test_chunks_without_spots_in_place(spark, tmp_path):
    table = img.write_bucketed(spots_image(spark, (32, 32), []), "buckets_none", str(tmp_path / "none"), AXES[2], 2)
    assert chain.detect_in_place(table, AXES[2], FIXED, (16, 16)).count() == 0
