"""Listing in tasks, image ranges over a crop, and arriving images by folder."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from punctum.operators import detect
from punctum.params import AXES, SpotParams
from punctum.sinks import spots as sink
from punctum.sources import containers, images as img
from punctum.sources.listing import list_objects
from punctum.streaming import outputs


@pytest.mark.parametrize("prefixes", [1, 3, 64])
def test_listing_of_nested_and_empty_folders(spark, tmp_path, prefixes):
    want = {}
    for n, name in enumerate(["top.tif", "a/one.tif", "a/b/two.csv", "a/b/c/d/three", "e e/ü%20+.tif", "a/b/four"]):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * n)
        want[f"file:{path}"] = n
    (tmp_path / "empty" / "deeper").mkdir(parents=True)
    for hidden in ("_SUCCESS", ".part.crc", "a/_temporary/0"):
        (tmp_path / hidden).parent.mkdir(exist_ok=True)
        (tmp_path / hidden).write_text("no")
    rows = list_objects(spark, str(tmp_path), prefixes).collect()
    assert {r.key: r["size"] for r in rows} == want and len(rows) == len(want)
    assert all(abs(r.modified.timestamp() - os.path.getmtime(r.key[5:])) < 1 for r in rows)
    assert list_objects(spark, str(tmp_path / "empty")).count() == 0
    assert list_objects(spark, str(tmp_path / "missing")).count() == 0


def image(seed, dims):
    return np.random.default_rng(seed).integers(1, 500, dims[::-1]).astype(float)


def chunk_rows(spark, arrays, dims, chunk, drop=()):
    """Chunk tables of arrays by image; ``drop`` names chunks that are missing."""
    axes, rows = AXES[len(dims)], []
    for name, array in arrays.items():
        for number, origin in enumerate(np.ndindex(*[-(-n // c) for n, c in zip(dims, chunk)])):
            start = [o * c for o, c in zip(origin, chunk)]
            width = [min(c, n - s) for c, n, s in zip(chunk, dims, start)]
            data = array[tuple(slice(s, s + w) for s, w in zip(start, width))[::-1]]
            if (name, number) in drop:
                data[:] = 0
            else:
                rows.append((name, number, *start, *[s + w - 1 for s, w in zip(start, width)], *width, *dims, data.ravel().tolist()))
    return spark.createDataFrame(rows, img.chunk_schema(axes))


@pytest.mark.parametrize("crop", [None, ((3, 2), (17, 9)), ((8, 0), (15, 11)), ((0, 0), (0, 0)), ((5, 5), (40, 40))])
def test_image_range_of_a_crop(spark, crop, tmp_path):
    dims, axes = (20, 12), AXES[2]
    arrays = {n: image(k, dims) for k, n in enumerate("abc")}
    chunks = chunk_rows(spark, arrays, dims, (8, 4), drop={("b", 4)})
    params = SpotParams(range_scope="image", crop_min=crop and crop[0], crop_max=crop and crop[1])
    box = (slice(None),) * 2 if crop is None else tuple(slice(l, h + 1) for l, h in zip(*crop))[::-1]
    want = {n: (a[box].min(), a[box].max()) for n, a in arrays.items()}
    read = lambda table: {r.image: (r.v_low, r.v_high) for r in detect.image_range(table, axes, params).collect()}
    assert read(chunks) == want
    img.write_images(chunks.drop("x1", "y1"), str(tmp_path / "zones"))
    zones = spark.read.schema(img.chunk_schema(axes, zones=True)).parquet(str(tmp_path / "zones"))
    assert read(zones) == want
    if crop is None:
        plan = detect.image_range(zones, axes, params)._jdf.queryExecution().executedPlan().toString()
        assert "data:" not in plan.split("ReadSchema", 1)[1].split(">")[0]


def test_image_range_of_a_crop_3d(spark):
    dims, axes, (lo, hi) = (9, 7, 6), AXES[3], ((2, 1, 1), (7, 4, 4))
    arrays = {"a": image(5, dims)}
    params = SpotParams(range_scope="image", crop_min=lo, crop_max=hi)
    inner = arrays["a"][tuple(slice(l, h + 1) for l, h in zip(lo, hi))[::-1]]
    (row,) = detect.image_range(chunk_rows(spark, arrays, dims, (4, 3, 4)), axes, params).collect()
    assert (row.v_low, row.v_high) == (inner.min(), inner.max())


def test_spots_of_a_crop_by_both_paths(spark):
    dims, axes = (40, 30), AXES[2]
    grid = np.stack(np.meshgrid(np.arange(30), np.arange(40), indexing="ij"), axis=-1)
    array = sum(h * np.exp(-((grid - np.array(c)) ** 2).sum(axis=-1) / 4.5) for c, h in (((10, 12), 90.0), ((20, 30), 60.0), ((15, 21), 75.0)))
    chunks = chunk_rows(spark, {"i": array}, dims, (16, 16))
    params = SpotParams(range_scope="image", threshold=0.02, block_size=(13, 11), crop_min=(5, 5), crop_max=(28, 25))
    rows = lambda df: sorted(tuple(round(r[c], 6) for c in ("x", "y", "intensity")) for r in df.collect())
    a = rows(detect.detect(chunks, axes, params))
    assert len(a) == 2 and a == rows(detect.spots_of(detect.voxel_gather(img.voxels_of_chunks(chunks, axes), axes, params), axes, params))


def test_arrivals_read_only_their_folders(spark, tmp_path, monkeypatch):
    dims, axes = (24, 24), AXES[2]
    grid = np.stack(np.meshgrid(np.arange(24), np.arange(24), indexing="ij"), axis=-1)
    spot = lambda x, y: 100 * np.exp(-((grid - np.array([y, x])) ** 2).sum(axis=-1) / 4.5)
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    params = SpotParams(max_intensity=100.0, threshold=0.02)
    opened = []
    monkeypatch.setattr(outputs, "folders_of", lambda batch, f=outputs.folders_of: opened.append(f(batch)) or opened[-1])
    run = lambda **options: outputs.detect_arrivals(spark, source, axes, params, target, state, **options).awaitTermination()
    found = lambda: sorted((r.image, round(r.x), round(r.y)) for r in outputs.arrived(spark, target, axes).collect())
    names = ["a b", "c/d%1", "é{}"]
    arrays = {n: spot(8 + k, 12) for k, n in enumerate(names)}
    img.write_images(chunk_rows(spark, arrays, dims, (24, 24)).drop("x1", "y1"), source)
    run()
    assert found() == sorted((n, 8 + k, 12) for k, n in enumerate(names)) and len(opened[0]) == 3
    late = {"a b": spot(15, 9)}
    img.write_images(chunk_rows(spark, late, dims, (24, 12)).filter("chunk_id = 1").drop("x1", "y1"), source, mode="append")
    run(files=1)
    assert len(opened) == 2 and [os.path.basename(f) for f in opened[1]] == ["image=a b"]
    assert {n for n, *_ in found()} == set(names)


@pytest.mark.parametrize("kind, packing", [("float32", "gzip"), ("uint16", "raw"), ("int8", "gzip"), ("float64", "raw")])
def test_round_trip_of_chunk_files(spark, tmp_path, kind, packing):
    dims, axes, block = (9, 7, 6), AXES[3], (4, 3, 4)
    arrays = {n: image(k, dims) % 100 for k, n in enumerate(["one", "a b", "c+%1"])}
    chunks = chunk_rows(spark, arrays, dims, block, drop={("one", 3)})
    containers.write_container(chunks, str(tmp_path), axes, block, kind, packing)
    columns = [c for c in chunks.columns if c != "chunk_id"]
    rows = lambda df: sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    got = containers.read_container(spark, str(tmp_path), axes)
    assert rows(got) == rows(chunks)
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.startswith(".") and not f.endswith(".crc")]
    assert {r.image for r in containers.read_container(spark, str(tmp_path), axes, images=["a b"]).collect()} == {"a b"}


def test_a_crop_opens_only_the_files_it_touches(spark, tmp_path):
    dims, axes, block = (20, 12), AXES[2], (4, 4)
    chunks = chunk_rows(spark, {"i": image(1, dims)}, dims, block)
    containers.write_container(chunks, str(tmp_path), axes, block, "float32", "raw")
    for crop in (((5, 3), (9, 8)), ((0, 0), (0, 0)), ((8, 8), (40, 40)), ((-5, 4), (3, 7)), ((25, 0), (30, 3))):
        want = {(x, y) for x in range(5) for y in range(3) if x * 4 <= crop[1][0] and x * 4 + 3 >= crop[0][0] and y * 4 <= crop[1][1] and y * 4 + 3 >= crop[0][1]}
        files = containers.chunk_files(containers.attributes(spark, str(tmp_path)), axes, crop)
        assert {(r.gx, r.gy) for r in files.collect()} == want
        assert {(r.x0 // 4, r.y0 // 4) for r in containers.read_container(spark, str(tmp_path), axes, crop).collect()} == want


def test_an_image_without_attributes_is_unfinished_and_files_are_whole(spark, tmp_path):
    axes, block = AXES[2], (4, 4)
    bad = chunk_rows(spark, {"i": image(1, (8, 8))}, (8, 8), block).withColumn("data", F.when(F.col("chunk_id") == 2, F.array(F.lit(None).cast("float"))).otherwise(F.col("data")))
    bad = bad.withColumn("wx", F.when(F.col("chunk_id") == 2, F.lit(-1)).otherwise(F.col("wx")))
    with pytest.raises(Exception):
        containers.write_container(bad, str(tmp_path), axes, block, "uint16", "raw")
    assert not (tmp_path / "i" / "attributes.json").exists()
    assert all(os.path.getsize(os.path.join(d, f)) == 12 + 32 for d, _, names in os.walk(tmp_path) for f in names if not f.endswith(".crc"))
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "attributes.json").write_text('{"dimensions": [8, 8], "blockSize": [4, 4], "dataType": "uint8", "compressionType": "raw"}')
    assert containers.attributes(spark, str(tmp_path)).collect()[0].packing == "raw"
    assert containers.read_container(spark, str(tmp_path), axes).count() == 0


def spot_rows(spark, counts, bad=None):
    """Spots of each image; the value of one line can be made to fail."""
    rows = [(n, float(k), 1.0, 2.0) for n, count in counts.items() for k in range(count)]
    table = spark.createDataFrame(rows, "image string, x double, y double, intensity double")
    return table if bad is None else table.withColumn("y", F.when((F.col("image") == bad) & (F.col("x") == 5), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("y")))


def test_an_object_per_image_is_whole(spark, tmp_path, monkeypatch):
    counts = {"a": 3, "b c.1": 12, "d/e%+": 1}
    images = spark.createDataFrame([(n,) for n in [*counts, "none"]], "image string")
    for part, number in ((1_000_000, 4), (5, 6)):
        monkeypatch.setattr(sink, "PART_SPOTS", part)
        path = str(tmp_path / f"{part}")
        for _ in range(2):  # the same objects again
            sink.write_objects_per_image(spot_rows(spark, counts), AXES[2], path, images)
        names = [f for f in os.listdir(path) if not f.endswith(".crc")]
        assert len(names) == number and not [f for f in names if f.startswith(".")]
        found = sink.read_objects_per_image(spark, path, AXES[2]).groupBy("image").count().collect()
        assert {r.image: r["count"] for r in found} == counts
        assert (tmp_path / f"{part}" / "none.csv").read_text() == "x,y,t,c,intensity\n"


def test_a_task_that_fails_leaves_no_part_of_an_object(spark, tmp_path, monkeypatch):
    from punctum.sources import objects

    kept, path = objects.WholeObject.complete, str(tmp_path / "out")
    system, where = objects.opened(objects.qualified(spark, path))
    system.create_dir(where)
    target = objects.WholeObject(system, f"{where}/a.csv")
    target.stream.write(b"half")
    target.discard()
    assert os.listdir(path) == []
    with pytest.raises(Exception):
        sink.write_objects_per_image(spot_rows(spark, {"a": 3, "b": 40}, bad="b"), AXES[2], path)
    assert all(os.path.getsize(os.path.join(path, f)) > 0 and f == "a.csv" for f in os.listdir(path))
    whole = objects.WholeObject(system, f"{where}/c.csv")
    whole.stream.write(b"all")
    kept(whole)
    whole.discard()
    assert (tmp_path / "out" / "c.csv").read_bytes() == b"all"


def test_sizes_come_from_footers(spark, tmp_path):
    dims, arrays = (40, 30), {"a+b c": np.ones((30, 40)), "00%7": np.zeros((30, 40))}
    path = str(tmp_path / "sizes")
    img.write_images(chunk_rows(spark, arrays, dims, (24, 24)).drop("x1", "y1"), path)
    wide = chunk_rows(spark, {"later": np.ones((10, 64))}, (64, 10), (24, 24)).drop("x1", "y1")
    img.write_images(wide, path, mode="append")
    got = img.footer_size(spark, path, ("x", "y"))
    assert sorted(map(tuple, got.collect())) == [("00%7", 40, 30, 4), ("a+b c", 40, 30, 4), ("later", 64, 10, 3)]
    assert img.footer_size(spark, str(tmp_path / "missing"), ("x", "y")).count() == 0


def test_sizes_without_statistics_are_read(tmp_path):
    table = pa.table({"nx": [4, 9, None], "ny": [7, 2, 5]})
    pq.write_table(table, tmp_path / "plain.parquet", write_statistics=False)
    assert list(img._largest(pq.ParquetFile(tmp_path / "plain.parquet"), ["nx", "ny"])) == [(9, 7, 3)]
