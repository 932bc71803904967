"""Streams over finished outputs and over incoming images."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.operators import progress
from punctum.params import SpotParams
from punctum.plans.spots import detect_images
from punctum.session import path_exists, scratch_path, written
from punctum.sources.images import chunk_schema, size_columns


def count_outputs(finished: DataFrame, interval: str, target: str, checkpoint: str):
    """Start counting finished outputs (rows with ``ts``) per polling interval.

    Complete mode and no watermark: an output counts however late it shows up, and state is one
    counter per interval. Every trigger replaces the counts at ``target``, so a retry is harmless.
    """
    counts = progress.poll_bins(finished, interval)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    return (
        counts.writeStream.outputMode("complete").foreachBatch(publish)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def output_count(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", interval: str = "1 hour") -> DataFrame:
    """Count all outputs that are there now as a stream; totals and growth per polling interval."""
    target, checkpoint = scratch_path(spark, "poll-counts"), scratch_path(spark, "poll-state")
    finished = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    count_outputs(finished.select("ts"), interval, target, checkpoint).awaitTermination()
    if not path_exists(spark, target):  # no output yet
        return spark.createDataFrame([], "poll timestamp, total bigint, processed bigint")
    return progress.poll_delta(spark.read.parquet(target), interval)


#: Files of a batch: its changed images are no more.
FILES = 10_000


def named_in(batch: DataFrame, axes) -> DataFrame:
    """``image, folders, nx, ny[, nz]``: the images of a batch, the folders of its files that have them, and their sizes."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return batch.groupBy("image").agg(F.collect_set(folder).alias("folders"), *[F.max(n).alias(n) for n in size_columns(axes)])


def folders_of(named: DataFrame) -> list[str]:
    """Folders of the files of a batch, at most one a file."""
    return sorted(unquote(r.folder) for r in named.select(F.explode("folders").alias("folder")).distinct().collect())


def detect_arrivals(spark: SparkSession, folder: str, axes, params: SpotParams, target: str, checkpoint: str, skip_finished: bool = False, files: int = FILES):
    """Detect spots in images as their chunk files arrive, and only in those.

    A batch is at most ``files`` new files and one detection. It reads the folders its files are in, no others are listed, so each image that
    changed is read whole, and gets a new version below ``target``: spots by batch, and a row per image and batch, also for
    images without spots. ``arrived`` reads the latest version of each image, so chunks that arrive late replace what was
    found before, and a batch that runs twice writes the same folders. With ``skip_finished`` images that have a version are left alone.
    """
    arrivals = spark.readStream.schema(chunk_schema(axes)).option("maxFilesPerTrigger", files).parquet(folder)

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # One pass over the new files; the sizes spare the detection one over all chunks of the images.
        named = written(named_in(batch, axes), "named")
        sizes = named.drop("folders")
        if skip_finished:
            earlier = versions(session, target).filter(F.col("batch") < batch_id)
            sizes = written(sizes.join(earlier, "image", "left_anti"), "changed")
        changed = sizes.select("image")
        if folders := folders_of(named):
            chunks = session.read.schema(chunk_schema(axes)).option("basePath", folder).parquet(*folders).join(changed, "image", "left_semi")
            detect_images(chunks, axes, params, sizes).write.mode("overwrite").parquet(f"{target}/spots/batch={batch_id}")
        changed.write.mode("overwrite").parquet(f"{target}/images/batch={batch_id}")

    return (
        arrivals.select("*", "_metadata").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def versions(spark: SparkSession, target: str) -> DataFrame:
    """``image, batch``: every finished version of every image."""
    if not path_exists(spark, f"{target}/images"):
        return spark.createDataFrame([], "image string, batch bigint")
    return spark.read.schema("image string, batch bigint").parquet(f"{target}/images")


def arrived(spark: SparkSession, target: str, axes) -> DataFrame:
    """Spots of the latest version of every image."""
    latest = versions(spark, target).groupBy("image").agg(F.max("batch").alias("batch"))
    schema = "image string, block_id bigint, {}, {}, intensity double, gradients bigint, inliers bigint, round bigint, batch bigint".format(
        ", ".join(f"s{a} bigint" for a in axes), ", ".join(f"{a} double" for a in axes))
    if not path_exists(spark, f"{target}/spots"):
        return spark.createDataFrame([], schema).drop("batch")
    return spark.read.schema(schema).parquet(f"{target}/spots").join(latest, ["image", "batch"], "left_semi").drop("batch")
