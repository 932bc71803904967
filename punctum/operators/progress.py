"""Result bookkeeping: counts per block and image, polling totals, task durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def merge_blocks(results: DataFrame) -> DataFrame:
    """Spots of all blocks from rows ``image, block_id, points``; blocks without a result vanish."""
    return drop_null_results(results).select("image", "block_id", F.inline("points"))


def drop_null_results(results: DataFrame) -> DataFrame:
    return results.filter(F.col("points").isNotNull())


def per_block(spots: DataFrame, blocks: DataFrame) -> DataFrame:
    """Spots of every block, zero included. Spots aggregate before they meet the block list."""
    counts = spots.groupBy("image", "block_id").agg(F.count("*").alias("spots"))
    return blocks.select("image", "block_id").join(counts, ["image", "block_id"], "left").fillna(0, ["spots"])


def per_image(spots: DataFrame) -> DataFrame:
    return spots.groupBy("image").agg(F.count("*").alias("spots"))


def every_image(spots: DataFrame, images: DataFrame) -> DataFrame:
    """One row per image, with 0 for images without spots: every input gets an output."""
    return images.select("image").join(per_image(spots), "image", "left").fillna(0, ["spots"])


def poll_bins(finished: DataFrame, interval: str) -> DataFrame:
    """Outputs finished per polling interval, from rows with a timestamp ``ts``."""
    bins = finished.groupBy(F.window("ts", interval).alias("w")).agg(F.count("*").alias("n"))
    return bins.select(F.col("w.start").alias("poll"), "n")


def poll_grid(bins: DataFrame, interval: str) -> DataFrame:
    """``poll, n`` for every interval from the first poll to the last, 0 where nothing came. The grid is generated in parallel."""
    spark, kind = bins.sparkSession, bins.schema["poll"].dataType.simpleString()
    step, first, count = bins.agg(F.min("poll").alias("a"), F.max("poll").alias("b")).selectExpr(
        f"unix_micros(timestamp_micros(0) + INTERVAL {interval}) AS step", "CAST(a AS STRING) AS a", "timestampdiff(MICROSECOND, a, b) AS span").first()
    if first is None:
        return bins.select("poll", "n").limit(0)
    at = f"CAST('{first}' AS {kind}) + make_dt_interval(0, 0, 0, CAST(id * {step} AS DECIMAL(18, 0)) / 1000000)"
    grid = spark.range(count // step + 1).selectExpr("id", f"CAST({at} AS {kind}) AS poll")
    return grid.join(bins, "poll", "left").select("id", "poll", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def poll_delta(bins: DataFrame, interval: str) -> DataFrame:
    """Running total at every poll and its growth, also where it is 0; no growth on the first or after a total of 0.

    Runs per block of polls with the earlier blocks' sums added, so the one global window sees one row per block.
    """
    polls = poll_grid(bins, interval)
    if "id" not in polls.columns:
        return polls.select("poll", F.col("n").alias("total"), F.col("n").alias("processed"))
    polls = polls.withColumn("block", F.expr("id div 4096"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = polls.groupBy("block").agg(F.sum("n").alias("block_sum"))
    offset = offset.select("block", F.coalesce(F.sum("block_sum").over(earlier), F.lit(0)).alias("before"))
    so_far = Window.partitionBy("block").orderBy("poll").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = polls.join(offset, "block").withColumn("total", F.sum("n").over(so_far) + F.col("before"))
    return out.select("poll", "total", F.when(F.col("total") > F.col("n"), F.col("n")).alias("processed"))


def parse_time_log(lines: DataFrame) -> DataFrame:
    """``task, state, ts, elapsed`` from lines ``TimeLog:task;START;ms`` and ``TimeLog:task;DONE;ms;elapsed``."""
    p = F.split("line", ";", -1)
    return lines.filter(F.col("line").startswith("TimeLog:")).select(
        F.substring(p[0], 9, 1 << 30).alias("task"), p[1].alias("state"),
        p[2].cast("bigint").alias("ts"), F.try_element_at(p, F.lit(4)).cast("bigint").alias("elapsed"),
    )


def task_durations(log: DataFrame) -> DataFrame:
    """One row per run of a task: every START with the DONE that follows it, if the next line is one.

    ``run`` counts from 1; ``status`` is open, done, or mismatch where the logged time differs from the measured one.
    A task may be retried. Of lines of one moment, the end of an earlier run comes before a START, an end of no duration after it.
    """
    line = F.when(F.col("state") == "START", 1).when(F.coalesce("elapsed", F.lit(0)) > 0, 0).otherwise(2)
    order = Window.partitionBy("task").orderBy("ts", line)
    after = lambda c: F.when(F.lead("state").over(order) == "DONE", F.lead(c).over(order))
    runs = log.select("task", "state", "ts", after("ts").alias("done"), after("elapsed").alias("logged"), F.sum(F.when(F.col("state") == "START", 1)).over(order).cast("int").alias("run"))
    out = runs.filter("state = 'START'").select("task", "run", F.col("ts").alias("started"), "done", "logged").withColumn("duration", F.col("done") - F.col("started"))
    status = F.when(F.col("done").isNull(), "open").when(F.col("duration") == F.col("logged"), "done").otherwise("mismatch")
    return out.withColumn("status", status)
