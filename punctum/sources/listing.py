"""Listings, task texts and accept lists read from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.sources.objects import PREFIXES, SCHEMES, Objects, qualified


def list_objects(spark: SparkSession, root: str, prefixes: int = PREFIXES) -> DataFrame:
    """``key, size, modified`` of all files below a folder, without reading their content.

    Tasks list the folders (see ``objects.Objects``), so the driver never holds the keys. A file system that tasks
    can't open without Spark is listed by Spark's own file index.
    """
    whole = qualified(spark, root)
    if whole.partition(":")[0] in SCHEMES:
        spark.dataSource.register(Objects)
        return spark.read.format(Objects.name()).option("prefixes", prefixes).load(whole)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(whole)
    return files.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_task_texts(spark: SparkSession, path: str) -> DataFrame:
    """``chunk, text``: one task text per file, as ``write_manifests`` lays them out."""
    texts = spark.read.schema("value string, chunk bigint").option("wholetext", True).text(path)
    return texts.select("chunk", F.regexp_replace("value", "\\s+$", "").alias("text"))


def read_accept_list(spark: SparkSession, path: str) -> DataFrame:
    """Second field of a CSV list without its header line, quotes removed; commas always separate."""
    fields = spark.read.schema("first string, second string").option("header", True).option("quote", "").csv(path)
    return fields.select(F.replace("second", F.lit('"'), F.lit("")).alias("name"))


def read_manifest_parts(spark: SparkSession, path: str) -> DataFrame:
    """``chunk, input, output`` from manifests in parts: one pair a line."""
    lines = spark.read.schema("value string, chunk bigint, part bigint").text(path).filter(F.col("value").startswith("-i "))
    tokens = F.split("value", " ", -1)
    checked = F.when((F.size(tokens) == 4) & (tokens[2] == "-o"), tokens[1]).otherwise(F.raise_error(F.concat(F.lit("not an input and an output: "), F.col("value"))).cast("string"))
    return lines.select("chunk", checked.alias("input"), tokens[3].alias("output"))
