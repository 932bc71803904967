"""Images, listings and logs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.params import AXES
from punctum.sources import images as img

EVENT_CHUNK = (64, 30)
ORDER_CHUNK = (64, 50, 11)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_cells(events: DataFrame) -> DataFrame:
    """One 2D image per event type: user by day, integer cents."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (
        events.groupBy(F.col("event_type").alias("image"), F.col("user_id").alias("x"), (F.day("ts") - 1).cast("bigint").alias("y"))
        .agg(F.sum(cents).alias("v"))
    )


def order_cells(lines: DataFrame) -> DataFrame:
    """One 3D image: supplier by quantity by discount, number of order lines."""
    return (
        lines.groupBy(
            F.lit("lines").alias("image"),
            F.col("l_suppkey").alias("x"),
            (F.col("l_quantity").cast("bigint") - 1).alias("y"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("z"),
        )
        .agg(F.count("*").alias("v"))
    )


def _extent(df: DataFrame, *exprs) -> tuple[int, ...]:
    """Image size: one row of maxima, read on the driver like any dataset's metadata."""
    return tuple(int(v) + 1 for v in df.agg(*[F.max(e) for e in exprs]).first())


def event_chunks(spark, sf_dir, dense: bool = True) -> DataFrame:
    events = table(spark, sf_dir, "events")
    dims = _extent(events, F.col("user_id"), F.day("ts") - 1)
    images = events.select(F.col("event_type").alias("image")).distinct() if dense else None
    return img.chunk_table(event_cells(events), AXES[2], dims, EVENT_CHUNK, images)


def order_chunks(spark, sf_dir, dense: bool = True) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    dims = _extent(lines, F.col("l_suppkey"), F.col("l_quantity").cast("bigint") - 1, F.round(F.col("l_discount") * 100).cast("bigint"))
    images = spark.range(1).select(F.lit("lines").alias("image")) if dense else None
    return img.chunk_table(order_cells(lines), AXES[3], dims, ORDER_CHUNK, images)


def event_voxels(spark, sf_dir) -> DataFrame:
    return img.voxels_of_chunks(event_chunks(spark, sf_dir), AXES[2])


def order_voxels(spark, sf_dir) -> DataFrame:
    return img.voxels_of_chunks(order_chunks(spark, sf_dir), AXES[3])


def vector_lines(spark, sf_dir) -> DataFrame:
    """Float image whose scan lines are the embeddings."""
    vectors = table(spark, sf_dir, "embeddings")
    nx, ny = (int(v) for v in vectors.agg(F.max(F.size("embedding")), F.max("vec_id") + 1).first())
    return vectors.select(
        F.lit("vectors").alias("image"), F.col("vec_id").alias("y"),
        F.lit(nx).cast("bigint").alias("nx"), F.lit(ny).cast("bigint").alias("ny"),
        F.col("embedding").alias("line"),
    )


def vector_voxels(spark, sf_dir) -> DataFrame:
    return img.voxels_of_lines(vector_lines(spark, sf_dir), AXES[2])


def listing(spark, sf_dir) -> DataFrame:
    """Object listing ``key, size``."""
    d = F.col("doc_id")
    tag = F.when(d % 5 == 4, F.lit("")).otherwise(F.concat(F.lit("c"), (d % 4).cast("string"), F.lit("_")))
    ext = F.when(d % 3 == 0, F.lit(".csv")).otherwise(F.lit(".tif"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("data/"), F.col("source"), F.lit("/"), tag, F.lit("d"), d.cast("string"), ext).alias("key"),
        F.when(d % 7 == 0, F.lit(0).cast("bigint")).otherwise(F.col("n_chars")).alias("size"),
    )


def finished_names(spark, sf_dir) -> DataFrame:
    """Base names of outputs that exist already."""
    d = F.col("doc_id")
    return (
        table(spark, sf_dir, "documents")
        .filter((d % 3 != 0) & (d % 5 < 2))
        .select(F.concat(F.lit("c"), (d % 4).cast("string"), F.lit("_d"), d.cast("string")).alias("name"))
    )


def accept_names(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "labels").filter("quality = 1")
        .select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".tif")).alias("name"))
    )


def time_log(spark, sf_dir) -> DataFrame:
    """Log lines; every tenth task's first run never finishes, every fifteenth task runs again."""
    e = table(spark, sf_dir, "events").select("event_id", F.round(F.col("value") * 100).cast("bigint").alias("ms"))
    head = F.concat(F.lit("TimeLog:t"), F.col("event_id").cast("string"))
    start = F.concat(head, F.lit(";START;"), (F.col("event_id") * 1000).cast("string"))
    done = F.concat(head, F.lit(";DONE;"), (F.col("event_id") * 1000 + F.col("ms")).cast("string"), F.lit(";"), F.col("ms").cast("string"))
    later = F.col("event_id") * 1000 + 500_000_000
    retry = F.array(
        F.concat(head, F.lit(";START;"), later.cast("string")),
        F.concat(head, F.lit(";DONE;"), (later + 7).cast("string"), F.lit(";7")))
    lines = F.when(F.col("event_id") % 10 != 0, F.array(start, done)).otherwise(F.array(start))
    return e.select(F.explode(F.when(F.col("event_id") % 15 == 0, F.concat(lines, retry)).otherwise(lines)).alias("line"))


def spot_sets(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two spot tables ``id, x, y``: the second is a shifted copy with gaps."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    x = F.col("user_id") + (i % 97) / F.lit(97.0)
    y = F.day("ts") + (i % 89) / F.lit(89.0)
    first = e.select(i.alias("id"), x.alias("x"), y.alias("y"))
    second = e.filter(i % 11 != 0).select(i.alias("id"), (x + (i % 7) * F.lit(0.0023)).alias("x"), y.alias("y"))
    return first, second
