"""Tables, words, blocks of texts and stored tables shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctum.session import scratch_path

TAU = 2.0**64
#: Stands for a null id where ids are ordered: after every other id.
NO_ID = 2**63 - 1
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """The fold of a row: crc32 of its id as text, modulo 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back with its schema: lineage ends here.

    Nothing reads the shuffle files of the write again, so they go as soon as it is done.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def release(table: DataFrame) -> None:
    """Delete a table from ``stored`` that nothing reads any more."""
    target = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    target.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts hold at most ``limit`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def free_prefix(names: list[str], wanted: str) -> str:
    """``wanted``, longer by as many ``_`` as no given column name begins with it."""
    while any(name.lower().startswith(wanted.lower()) for name in names):
        wanted += "_"
    return wanted
