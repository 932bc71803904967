import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from punctum.operators import worklist
from punctum.params import AXES
from punctum.plans import oracle, queries
from punctum.session import scratch_path
from punctum.sinks import spots as sink
from punctum.sources import images as img
from tests.conftest import SF


def test_every_query_has_sql():
    assert queries.registry().keys() == oracle.registry().keys()
    assert queries.registry().keys() <= entry_point.queries().keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


def test_flagship_runs(spark):
    assert entry_point.entry(spark).count() > 0


def test_unknown_layout_raises(spark):
    with pytest.raises(ValueError):
        img.scan_images(spark, "anywhere", AXES[2], layout="tape")


def test_no_spots_still_give_a_header(spark):
    path = scratch_path(spark, "none")
    empty = spark.createDataFrame([], "x double, y double, intensity double")
    sink.write_csv(empty, AXES[2], path, single=True)
    text = [r.value for r in spark.read.text(path).collect()]
    assert text in (["x,y,t,c,intensity"], [])
    assert sink.read_csv(spark, path, AXES[2]).count() == 0


def test_manifest_keeps_every_file_once(spark):
    keys = spark.range(101).select(F.format_string("k%03d", "id").alias("key"))
    for size, chunks in ((10, 11), (101, 1), (50, 3), (0, 1)):
        out = worklist.chunk_manifest(keys.repartition(5), size).collect()
        assert sorted(r.key for r in out) == [f"k{i:03d}" for i in range(101)]
        assert all(r.rn == int(r.key[1:]) for r in out) and len({r.chunk for r in out}) == chunks


def test_lists_of_different_length_raise(spark):
    lists = spark.createDataFrame([(1, ["a", "b"], ["c"])], "chunk int, inputs array<string>, outputs array<string>")
    with pytest.raises(Exception, match="differ"):
        worklist.zip_lists(lists, "chunk").collect()


def test_dataset_attributes(spark, tmp_path):
    (tmp_path / "attributes.json").write_text(
        # The key names of the file format.
        '{"dimensions": [200, 90], "blockSize": [40, 30], "dataType": "uint8", "compression": {"type": "raw"},'
        ' "pixelResolution": {"unit": "nm", "dimensions": [80.5, 81.0]}}')
    row = img.dataset_meta(spark, str(tmp_path)).first()
    assert row.ndim == 2 and row.dimensions == [200, 90] and row.dataType == "uint8" and row.pixelResolution.unit == "nm"


def test_stream_counts_equal_batch_counts(spark):
    a = queries.poll_delta(spark, SF).orderBy("poll").collect()
    b = queries.stream_output_count(spark, SF).orderBy("poll").collect()
    assert a == b and len(a) > 0
