"""From object listings ``key, size`` to work manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctum.functions import text
from punctum.session import scratch_root


def by_prefix_ext(listing: DataFrame, part: str, ext: str, base: str = "") -> DataFrame:
    """``uri`` of the keys that contain ``part`` and end with ``ext``."""
    return summaries(listing, part, ext).select(F.concat(F.lit(base), F.col("key")).alias("uri"))


def summaries(listing: DataFrame, part: str, ext: str) -> DataFrame:
    return listing.filter(F.col("key").contains(part) & F.col("key").endswith(ext)).select("key", "size")


def base_names(listing: DataFrame, part: str) -> DataFrame:
    return listing.filter(F.col("key").contains(part)).select(text.base_name(F.col("key")).alias("name"))


def input_exists(listing: DataFrame, prefix: str) -> DataFrame:
    """One row ``exists``: does any key start with ``prefix``? Stops at the first hit."""
    hit = listing.filter(F.col("key").startswith(prefix)).limit(1)
    return hit.agg((F.count("*") > 0).alias("exists"))


def funnel(listing: DataFrame, prefix: str, ext: str) -> DataFrame:
    """One row of counts: all keys, in the prefix, with the extension too, and not empty too."""
    a = F.col("key").startswith(prefix)
    b = a & F.col("key").endswith(ext)
    return listing.agg(
        F.count("*").alias("total"), F.count_if(a).alias("in_prefix"), F.count_if(b).alias("with_ext"),
        F.count_if(b & (F.col("size") > 0)).alias("valid"),
    )


def nonzero(listing: DataFrame, prefix: str, ext: str) -> DataFrame:
    return listing.filter(F.col("key").startswith(prefix) & F.col("key").endswith(ext) & (F.col("size") > 0))


def pending(inputs: DataFrame, finished: DataFrame) -> DataFrame:
    """Inputs (``key``) whose base name has no output yet (``name``)."""
    named = inputs.withColumn("name", text.base_name(F.col("key")))
    return named.join(finished.select("name"), "name", "left_anti").drop("name")


def accepted(inputs: DataFrame, accept: DataFrame) -> DataFrame:
    """Inputs whose file name without channel tag is in the accept list (``name``)."""
    named = inputs.withColumn("name", text.strip_channel_tag(text.file_name(F.col("key"))))
    return named.join(accept.select("name"), "name", "left_semi").drop("name")


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """Adds ``rn`` (from 0) in the order of a unique column, with no single-partition window.

    Rows are range-partitioned and written to the shared folder once; positions are local ranks
    plus the sizes of the ranges before. One row per range meets in the prefix sum.
    """
    spark = rows.sparkSession
    scratch_root(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, order).withColumn("range", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("range").count()
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    local = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    return ranged.withColumn("rn", local).join(starts, "range").withColumn("rn", (F.col("rn") + F.col("start")).cast("bigint")).drop("range", "start")


def chunk_manifest(inputs: DataFrame, chunk_size: int, order: str = "key") -> DataFrame:
    """Adds ``rn`` and ``chunk``: the ordered list in chunks of ``chunk_size`` files; 0 means one chunk."""
    if chunk_size < 0:
        raise ValueError("chunk_size must not be negative")
    chunk = F.floor(F.col("rn") / F.lit(chunk_size)) if chunk_size else F.lit(0).cast("bigint")
    return numbered(inputs, order).withColumn("chunk", chunk)


def manifest_entry(source: Column, target: Column) -> Column:
    return F.concat(F.lit("-i "), source, F.lit(" -o "), target)


def manifests(chunks: DataFrame, source: Column, target: Column, scalars: str | None = None) -> DataFrame:
    """One task text per chunk: the scalars, then ``-i in -o out`` per file, in order.

    A text holds one chunk, so its size is the chunk size the caller chose.
    """
    row = F.struct("rn", manifest_entry(source, target).alias("txt"))
    lines = chunks.groupBy("chunk").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["txt"]), " ")
    return lines.select("chunk", F.concat_ws(" ", F.lit(scalars) if scalars else F.lit(None).cast("string"), body).alias("text"))


def task_tokens(texts: DataFrame) -> DataFrame:
    """``chunk, pos, flag, value`` from task texts of single-space separated flag and value pairs."""
    t = F.split(F.trim("text"), " ", -1)
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(t) / F.lit(2)).cast("int") - 1), lambda i: F.struct(
        F.element_at(t, 2 * i + 1).alias("flag"), F.element_at(t, 2 * i + 2).alias("value")))
    checked = F.when(F.size(t) % 2 == 0, pairs).otherwise(F.raise_error(F.lit("flag without a value")).cast("array<struct<flag:string,value:string>>"))
    return texts.select("chunk", F.posexplode(checked).alias("pos", "p")).select("chunk", "pos", "p.flag", "p.value")


def task_inputs(texts: DataFrame) -> DataFrame:
    """``chunk, input, output``: the i-th ``-i`` of each text with its i-th ``-o``."""
    t = F.split(F.trim("text"), " ", -1)
    values = lambda flag: F.filter(F.transform(t, lambda v, i: F.when(v == flag, F.try_element_at(t, i + 2))), lambda v: v.isNotNull())
    lists = texts.select("chunk", values("-i").alias("inputs"), values("-o").alias("outputs"))
    return zip_lists(lists, "chunk")


def zip_lists(lists: DataFrame, *keep: str) -> DataFrame:
    """Pair the i-th of ``inputs`` with the i-th of ``outputs``; lists of different length raise."""
    same = F.size("inputs") == F.size("outputs")
    message = F.concat(F.lit("number of inputs "), F.size("inputs").cast("string"), F.lit(" and outputs "), F.size("outputs").cast("string"), F.lit(" differ"))
    pairs = F.when(same, F.arrays_zip(F.col("inputs").alias("input"), F.col("outputs").alias("output")))
    pairs = pairs.otherwise(F.raise_error(message).cast("array<struct<input:string,output:string>>"))
    return lists.select(*keep, F.inline(pairs).alias("input", "output"))
