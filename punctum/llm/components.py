"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import release, stored


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a bigint, b bigint)``; root is the smallest node reachable.

    Links join either way; loops and repeats are harmless, nulls are left out; an empty table gives
    an empty table. Each round reads and writes tables in the shared folder, and the driver sees only
    a count and a checksum per round. Every row of a round is a link, never a pair within a group.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = stored(links.select(high.alias("a"), low.alias("b")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        either = links.union(links.select("b", "a"))
        least = either.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = either.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.filter("a <> b").union(least.select("a", F.col("m").alias("b")))
        after = stored(small.distinct(), "links")
        now = _mark(after)
        release(links), release(large)
        links = after
        if now == mark:
            break
        mark = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
