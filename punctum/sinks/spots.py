"""Spot tables as CSV: ``x,y[,z],t,c,intensity`` with four decimals and t = c = 1."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.functions.text import four_decimals
from punctum.session import written
from punctum.sources.objects import WholeObject, opened, qualified


def formatted(spots: DataFrame, axes, *keep: str) -> DataFrame:
    return spots.select(
        *keep, *[four_decimals(F.col(a)).alias(a) for a in axes],
        F.lit(1).alias("t"), F.lit(1).alias("c"), four_decimals(F.col("intensity")).alias("intensity"),
    )


def write_csv(spots: DataFrame, axes, path: str, single: bool = False) -> None:
    """A folder of CSV parts, each with a header; an empty result still gets one part with the header.

    ``single`` asks for one part, for small results only.
    """
    out = formatted(spots, axes)
    (out.coalesce(1) if single else out).write.option("header", True).csv(path)


PART_SPOTS = 1_000_000


def write_csv_per_image(spots: DataFrame, axes, path: str, images: DataFrame | None = None) -> None:
    """A folder per image with CSV parts of about ``PART_SPOTS`` spots, each with the header.

    The number of parts follows from the image's measured spots, so a hot image is written by several tasks and a small one by one. An
    image of ``images`` without spots gets a part with the header alone.
    """
    _lines_per_image(spots, axes, images).select("image", "part", "value").write.partitionBy("image", "part").text(path)


def _lines_per_image(spots: DataFrame, axes, images: DataFrame | None) -> DataFrame:
    """``image, part, parts, value``: the lines of each part together and in order, the header first."""
    counts = spots.groupBy("image").agg(F.count("*").alias("spots"))
    if images is not None:
        counts = images.select("image").distinct().join(counts, "image", "left")
    parts = counts.select("image", F.greatest(F.lit(1), F.ceil(F.col("spots") / F.lit(PART_SPOTS))).cast("int").alias("parts"))
    parts = written(parts.fillna(1, ["parts"]), "parts")
    fields = [*axes, "t", "c", "intensity"]
    line = F.concat_ws(",", *[F.col(f).cast("string") for f in fields])
    body = formatted(spots, axes, "image").select("image", F.lit(1).alias("kind"), line.alias("value")).join(parts, "image")
    body = body.withColumn("part", F.pmod(F.xxhash64("value"), F.col("parts")).cast("int"))
    head = parts.select("image", F.lit(0).alias("kind"), F.lit(",".join(fields)).alias("value"), "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    columns = ["image", "part", "parts", "kind", "value"]
    return body.select(*columns).unionByName(head.select(*columns)).repartition("image", "part").sortWithinPartitions("image", "part", "kind")


def write_objects_per_image(spots: DataFrame, axes, path: str, images: DataFrame | None = None) -> None:
    """One object per image, ``<image>.csv``, or ``<image>,<part>.csv`` for images of more than ``PART_SPOTS`` spots; with ``images``
    also for those without spots.

    An object gets its name when all of its lines are in, so it is there whole or not at all. A task that fails leaves nothing of the
    object it was at, and one that runs again puts the same objects in place of its own.
    """
    where = qualified(spots.sparkSession, path)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(where)
        system.create_dir(folder, recursive=True)
        current, target = None, None
        try:
            for batch in batches:
                done = []
                for image, part, parts, value in zip(*(c.to_pylist() for c in batch.columns)):
                    if (image, part) != current:
                        if target is not None:
                            done.append(target.complete())
                        name = quote(image, safe=" ") + (f",{part}" if parts > 1 else "") + ".csv"
                        current, target = (image, part), WholeObject(system, f"{folder}/{name}")
                    target.stream.write(f"{value}\n".encode())
                yield pa.RecordBatch.from_pydict({"path": pa.array(done, pa.string())})
            last, target = ([target.complete()] if target is not None else []), None
            yield pa.RecordBatch.from_pydict({"path": pa.array(last, pa.string())})
        finally:
            if target is not None:
                target.discard()

    lines = _lines_per_image(spots, axes, images).select("image", "part", "parts", "value")
    lines.mapInArrow(put, "path string").write.format("noop").mode("overwrite").save()


def read_objects_per_image(spark: SparkSession, path: str, axes) -> DataFrame:
    out = spark.read.schema(schema(axes)).option("header", True).csv(f"{path}/*.csv")
    name = F.regexp_extract(F.col("_metadata.file_name"), "^(.*?)(,[0-9]+)?\\.csv$", 1)
    return out.select(F.url_decode(F.replace(name, F.lit("%25"), F.lit("%"))).alias("image"), *axes, "t", "c", "intensity")


def schema(axes) -> str:
    return ", ".join([*[f"{a} double" for a in axes], "t int", "c int", "intensity double"])


def read_csv(spark: SparkSession, path: str, axes) -> DataFrame:
    return spark.read.schema(schema(axes)).option("header", True).csv(path)


def read_csv_per_image(spark: SparkSession, path: str, axes) -> DataFrame:
    out = spark.read.schema(schema(axes) + ", image string, part int").option("header", True).csv(path)
    return out.select("image", *axes, "t", "c", "intensity")


def count_per_image(spark: SparkSession, path: str) -> DataFrame:
    """``image, spots`` from the files themselves: lines without the headers, 0 for a header alone."""
    lines = spark.read.schema("value string, image string, part int").text(path)
    return lines.groupBy("image").agg(F.count_if(~F.col("value").startswith("x,")).alias("spots"))


def write_manifests(texts: DataFrame, path: str) -> None:
    """One folder per chunk, each holding its task text."""
    texts.select("chunk", "text").write.partitionBy("chunk").text(path)


def write_manifest_parts(entries: DataFrame, path: str, scalars: str | None = None, lines: int = 100_000) -> None:
    """Manifests of any length: a folder per chunk, in it parts of ``lines`` entries in order, the scalars first.

    ``entries`` has ``chunk, rn, txt``. No chunk is gathered in one row or one task.
    """
    head = entries.select("chunk").distinct().select("chunk", F.lit(0).cast("bigint").alias("part"), F.lit(-1).cast("bigint").alias("rn"), F.lit(scalars or "").alias("value"))
    first = entries.groupBy("chunk").agg(F.min("rn").alias("least"))
    body = entries.join(first, "chunk").select("chunk", F.expr(f"(rn - least) div {lines}").alias("part"), "rn", F.col("txt").alias("value"))
    ordered = body.unionByName(head).repartition("chunk", "part").sortWithinPartitions("chunk", "part", "rn")
    ordered.select("chunk", "part", "value").write.partitionBy("chunk", "part").text(path)
