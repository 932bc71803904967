"""Image tables.

chunk table   image, chunk_id, x0, y0[, z0], wx, wy[, wz], nx, ny[, nz], data ARRAY<FLOAT>
              one row per stored chunk; dimension 0 runs fastest in ``data``; a missing
              chunk is all zero. Stored tables also have the inclusive ends x1, y1[, z1], so a
              crop is a range test on plain columns and skips row groups.
line table    image, y[, z], nx, ny[, nz], line ARRAY<FLOAT>; one row per scan line along x.
voxel table   image, x, y[, z], v DOUBLE, nx, ny[, nz]; one row per pixel.

``nx, ny[, nz]`` are the image's size, so images of different sizes share one table.
"""

from __future__ import annotations

import math

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from punctum.functions import geometry as geo
from punctum.functions.arrow import schema_of
from punctum.sources.listing import list_objects
from punctum.sources.objects import SCHEMES, opened, qualified

LAYOUTS = ("chunks", "lines")

META = T.StructType([
    T.StructField("dimensions", T.ArrayType(T.LongType())),
    T.StructField("blockSize", T.ArrayType(T.IntegerType())),
    T.StructField("dataType", T.StringType()),
    T.StructField("compression", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("useZlib", T.BooleanType()),
        T.StructField("level", T.IntegerType()),
    ])),
    T.StructField("pixelResolution", T.StructType([
        T.StructField("unit", T.StringType()),
        T.StructField("dimensions", T.ArrayType(T.DoubleType())),
    ])),
])


def size_columns(axes) -> list[str]:
    return ["n" + a for a in axes]


def chunk_table(cells: DataFrame, axes, dims, chunk, images: DataFrame | None = None) -> DataFrame:
    """Pack sparse cells ``image, x, y[, z], v`` into chunk rows.

    ``dims`` and ``chunk`` are integers per axis. With ``images`` (one column) the chunks
    without any cell are added as zeros; without it they stay missing.
    """
    counts = [-(-n // c) for n, c in zip(dims, chunk)]
    number = geo.linear_id([f"floor({a} / {c})" for a, c in zip(axes, chunk)], [f"{n}L" for n in counts])
    # Where a chunk lies follows from its number alone.
    strides = [math.prod(counts[:d]) for d in range(len(axes))]
    origin = lambda i: [f"CAST(pmod({i} div {s}, {n}) * {c} AS BIGINT)" for s, n, c in zip(strides, counts, chunk)]
    width = lambda i: [f"CAST(least({c}, {n} - {o}) AS INT)" for c, n, o in zip(chunk, dims, origin(i))]
    offset = geo.linear_id([f"({a} - {o})" for a, o in zip(axes, origin('chunk_id'))], width('chunk_id'))
    entries = cells.selectExpr("image", f"{number} AS chunk_id", *axes, "v").selectExpr(
        "image", "chunk_id", f"struct(CAST({offset} AS INT) AS o, CAST(v AS FLOAT) AS v) AS e")
    packed = entries.groupBy("image", "chunk_id").agg(F.sort_array(F.collect_list("e")).alias("e"), F.max("chunk_id").alias("i"))
    # From here a chunk's place is an aggregate's result: filters on it run once per chunk, not once per cell.
    if images is not None:
        every = images.selectExpr("image", f"explode(sequence(0L, {math.prod(counts) - 1}L)) AS chunk_id")
        packed = every.join(packed.drop("i"), ["image", "chunk_id"], "left").withColumn("i", F.col("chunk_id"))
    return packed.selectExpr(
        "image", "chunk_id", *[f"{o} AS {a}0" for a, o in zip(axes, origin("i"))], *[f"{w} AS w{a}" for a, w in zip(axes, width("i"))],
        *[f"{n}L AS n{a}" for a, n in zip(axes, dims)], f"{_dense('e', ' * '.join(width('i')))} AS data")


def _dense(entries: str, n: str) -> str:
    """SQL text: array of n floats from entries (o, v) sorted by o; gaps are zero."""
    zero = "CAST(0 AS FLOAT)"
    before = f"concat(array(struct(-1 AS o, {zero} AS v)), slice({entries}, 1, size({entries}) - 1))"
    pieces = f"zip_with({entries}, {before}, (e, p) -> concat(array_repeat({zero}, e.o - p.o - 1), array(e.v)))"
    tail = f"array_repeat({zero}, {n} - 1 - element_at({entries}, -1).o)"
    return f"CASE WHEN {entries} IS NULL THEN array_repeat({zero}, {n}) ELSE concat(flatten({pieces}), {tail}) END"


def crop_chunks(chunks: DataFrame, axes, lo, hi) -> DataFrame:
    """Stored chunks that touch the inclusive crop; both bounds of every axis reach the scan."""
    for a, l, h in zip(axes, lo, hi):
        chunks = chunks.filter((F.col(a + "0") <= h) & (F.col(a + "1") >= l))
    return chunks


def voxels_of_chunks(chunks: DataFrame, axes) -> DataFrame:
    """One row per pixel of every stored chunk."""
    keep = ["image", *[a + "0" for a in axes], *["w" + a for a in axes], *size_columns(axes)]
    out, rest, position = chunks.selectExpr(*keep, "posexplode(data) AS (o, v)"), "o", []
    for a in axes[:-1]:
        position.append(f"{a}0 + {rest} % w{a} AS {a}")
        rest = f"({rest} div w{a})"
    position.append(f"{axes[-1]}0 + {rest} AS {axes[-1]}")
    return out.selectExpr("image", *position, "CAST(v AS DOUBLE) AS v", *size_columns(axes))


def voxels_of_lines(lines: DataFrame, axes) -> DataFrame:
    others = [*axes[1:], *size_columns(axes)]
    out = lines.select("image", *others, F.posexplode("line").alias("x", "v"))
    return out.select("image", F.col("x").cast("bigint").alias("x"), *axes[1:], F.col("v").cast("double").alias("v"), *size_columns(axes))


def chunk_schema(axes, zones: bool = False) -> str:
    """Schema of stored chunk rows; given to every read, so that image names stay text. ``zones``: with each chunk's least and largest value."""
    return ", ".join(
        ["image string", "chunk_id bigint", *[f"{a}0 bigint" for a in axes], *[f"{a}1 bigint" for a in axes], *[f"w{a} int" for a in axes],
         *[f"n{a} bigint" for a in axes], "data array<float>", *(["v_min float", "v_max float"] if zones else [])])


def line_schema(axes) -> str:
    return ", ".join(["image string", *[f"{a} bigint" for a in axes[1:]], *[f"n{a} bigint" for a in axes], "line array<float>"])


def write_images(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder per image; chunk rows get their inclusive ends and a zone map, and are ordered by origin, so row groups are compact."""
    axes = [c[0] for c in table.columns if c in ("x0", "y0", "z0")]
    if axes:
        table = table.withColumns({a + "1": F.col(a + "0") + F.col("w" + a) - 1 for a in axes})
        table = table.withColumns({"v_min": F.array_min("data"), "v_max": F.array_max("data")})
        table = table.sortWithinPartitions("image", *[a + "0" for a in reversed(axes)])
    table.write.mode(mode).partitionBy("image").parquet(path)


def write_bucketed(chunks: DataFrame, name: str, path: str, axes, buckets: int) -> DataFrame:
    """Chunk rows as the table ``name`` in ``buckets`` buckets by image and chunk number, stored at ``path``; returns the table.

    ``detect.in_place_gather`` reads it without moving the chunks. A task reads one bucket, so a bucket should hold some dozens of chunks.
    """
    table = chunks.withColumns({a + "1": F.col(a + "0") + F.col("w" + a) - 1 for a in axes} | {"v_min": F.array_min("data"), "v_max": F.array_max("data")})
    rows = table.repartition(buckets, "image", "chunk_id").write.bucketBy(buckets, "image", "chunk_id").sortBy("image", "chunk_id")
    rows.option("path", path).saveAsTable(name)
    return chunks.sparkSession.table(name)


def scan_images(spark: SparkSession, path: str, axes, layout: str = "chunks", crop=None) -> DataFrame:
    """Voxels of an image table on any file system Spark reads (``file:``, ``hdfs:``, ``s3a:``)."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout {layout!r} is not one of {LAYOUTS}")
    table = spark.read.schema(line_schema(axes) if layout == "lines" else chunk_schema(axes)).parquet(path)
    if layout == "lines":
        voxels = voxels_of_lines(table, axes)
    else:
        voxels = voxels_of_chunks(crop_chunks(table, axes, *crop) if crop else table, axes)
    return crop_voxels(voxels, axes, *crop) if crop else voxels


def crop_voxels(voxels: DataFrame, axes, lo, hi) -> DataFrame:
    for a, l, h in zip(axes, lo, hi):
        voxels = voxels.filter(F.col(a).between(l, h))
    return voxels


def dataset_meta(spark: SparkSession, path: str) -> DataFrame:
    """Dataset attributes files (JSON): size, block size, pixel type, pixel size; with ``image`` if they lie in a folder each."""
    schema = T.StructType([*META.fields, T.StructField("image", T.StringType())])
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("ndim", F.size("dimensions"))


def stored_size(rows: DataFrame, axes) -> DataFrame:
    """Size of every image from the size columns of its chunk or line rows, without reading a pixel."""
    return rows.groupBy("image").agg(*[F.max("n" + a).alias("n" + a) for a in axes])


def footer_size(spark: SparkSession, path: str, axes) -> DataFrame:
    """``image, nx, ny[, nz], chunks``: size and number of rows of every image of a table stored by ``write_images``.

    Tasks list the files and read their footers, which hold the largest value of every column of a row group; no column is read
    but one that lacks it. A file system that tasks can't open is read by Spark, by its size columns.
    """
    columns = size_columns(axes)
    if qualified(spark, path).partition(":")[0] not in SCHEMES:
        rows = spark.read.schema(chunk_schema(axes)).parquet(path)
        return rows.groupBy("image").agg(*[F.max(n).alias(n) for n in columns], F.count("*").alias("chunks"))
    shape = ", ".join(["key string", *[f"{n} bigint" for n in columns], "chunks bigint"])
    arrow = schema_of(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                system, name = opened(key)
                with system.open_input_file(name) as stream:
                    rows += [(key, *found) for found in _largest(pq.ParquetFile(stream), columns)]
            values = zip(*rows) if rows else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(values, arrow)], schema=arrow)

    files = list_objects(spark, path).filter(F.col("key").endswith(".parquet")).select("key")
    part = F.replace(F.regexp_extract("key", "/image=([^/]*)/[^/]*$", 1), F.lit("+"), F.lit("%2B"))
    image = F.when(part != "__HIVE_DEFAULT_PARTITION__", F.try_url_decode(part)).alias("image")
    found = files.mapInArrow(run, shape).groupBy(image)
    return found.agg(*[F.max(n).alias(n) for n in columns], F.sum("chunks").alias("chunks"))


def _largest(file: pq.ParquetFile, columns: list[str]) -> Iterator[tuple]:
    """Largest value of each column and number of rows, by row group."""
    place = {file.metadata.schema.column(i).path: i for i in range(file.metadata.num_columns)}
    for g in range(file.metadata.num_row_groups):
        group = file.metadata.row_group(g)
        if group.num_rows == 0:
            continue
        known = [group.column(place[c]).statistics for c in columns]
        if all(s is not None and s.has_min_max for s in known):
            yield *[s.max for s in known], group.num_rows
        else:
            values = file.read_row_group(g, columns=columns)
            yield *[max((v for v in values[c].to_pylist() if v is not None), default=None) for c in columns], group.num_rows
