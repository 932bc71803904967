"""Containers with a file per chunk: a folder per image, its attributes as JSON, and chunk files named by their place in the grid.

A chunk file is a header of big-endian numbers (mode, number of axes, width per axis) and the pixels, first axis fastest,
big-endian, raw or as gzip. The layout and the names of the pixel types are fixed values of the format.
"""

from __future__ import annotations

import gzip
import json
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.functions.arrow import schema_of
from punctum.sources.images import chunk_schema
from punctum.sources.objects import SCHEMES, WholeObject, opened, qualified

ATTRIBUTES = "dimensions array<bigint>, blockSize array<bigint>, dataType string, compression struct<type: string>, compressionType string"
TYPES = {"uint8": ">u1", "uint16": ">u2", "uint32": ">u4", "uint64": ">u8", "int8": ">i1", "int16": ">i2", "int32": ">i4", "int64": ">i8", "float32": ">f4", "float64": ">f8"}
#: Chunk files that one task reads.
FILES = 64
MOST_TASKS = 100_000


def attributes(spark: SparkSession, root: str) -> DataFrame:
    """``image, folder, dimensions, block, kind, packing`` of every image below ``root``, read in tasks.

    ``image`` is the name of the folder. An image whose attributes are missing is unfinished and has no row.
    """
    whole = qualified(spark, root).rstrip("/")
    if whole.partition(":")[0] not in SCHEMES:
        raise ValueError(f"tasks can't open files of {whole}")
    found = spark.read.schema(ATTRIBUTES).option("multiLine", True).json(f"{whole}/*/attributes.json")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    image = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return found.select(
        image.alias("image"), F.concat(F.lit(whole + "/"), image).alias("folder"), "dimensions", F.col("blockSize").alias("block"), F.col("dataType").alias("kind"),
        F.coalesce("compression.type", "compressionType", F.lit("raw")).alias("packing"))


def chunk_files(images: DataFrame, axes, crop=None) -> DataFrame:
    """A row for each chunk file that the inclusive ``crop`` (all, if none) touches, by arithmetic on the attributes: no folder is listed."""
    lo, hi = crop or ([0] * len(axes), [None] * len(axes))
    out, number, stride = images, F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    for d, a in enumerate(axes):
        size, block = F.col("dimensions")[d], F.col("block")[d]
        last = size - 1 if hi[d] is None else F.least(size - 1, F.lit(hi[d]))
        first, end = F.floor(F.lit(max(0, lo[d])) / block).cast("bigint"), F.floor(last / block).cast("bigint")
        out = out.withColumn("g" + a, F.explode(F.when(last >= max(0, lo[d]), F.sequence(first, end))))
        number, stride = number + F.col("g" + a) * stride, stride * F.ceil(size / block).cast("bigint")
    return out.withColumns({"chunk_id": number, **{"n" + a: F.col("dimensions")[d] for d, a in enumerate(axes)}})


def read_container(spark: SparkSession, root: str, axes, crop=None, images: list[str] | None = None) -> DataFrame:
    """Chunk rows (``chunk_schema``) of all images, or of ``images``; tasks read the files that the crop touches and no others.

    A file that is missing has no row: its pixels are 0.
    """
    axes = list(axes)
    meta = attributes(spark, root)
    files = chunk_files(meta if images is None else meta.filter(F.col("image").isin(images)), axes, crop)
    shape, where = chunk_schema(axes), qualified(spark, root)
    arrow = schema_of(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(where)
        for batch in batches:
            for row in batch.to_pylist():
                path = "/".join([opened(row["folder"])[1], *(str(row["g" + a]) for a in axes)])
                try:
                    with system.open_input_stream(path) as stream:
                        data = stream.read()
                except FileNotFoundError:
                    continue
                width, pixels = decoded(data, row["kind"], row["packing"])
                start = [row["g" + a] * b for a, b in zip(axes, row["block"])]
                values = [row["image"], row["chunk_id"], *start, *[s + w - 1 for s, w in zip(start, width)], *width, *[row["n" + a] for a in axes]]
                yield pa.RecordBatch.from_arrays([*[pa.array([v], f.type) for v, f in zip(values, arrow)], pa.array([pixels.astype(np.float32)], arrow.field("data").type)], schema=arrow)

    parts = max(1, min(MOST_TASKS, -(-(files.count()) // FILES)))
    return files.repartition(parts).mapInArrow(run, shape)


def decoded(data: bytes, kind: str, packing: str) -> tuple[tuple[int, ...], np.ndarray]:
    """Widths and pixels of a chunk file."""
    mode, ndim = struct.unpack_from(">HH", data)
    width = struct.unpack_from(f">{ndim}I", data, 4)
    body = data[4 + 4 * ndim + (4 if mode == 1 else 0) :]
    if packing not in ("raw", "gzip"):
        raise ValueError(f"chunks are packed as {packing!r}, not raw or gzip")
    pixels = np.frombuffer(gzip.decompress(body) if packing == "gzip" else body, TYPES[kind])
    return width, pixels[: math.prod(width)]


def encoded(width: list[int], pixels: np.ndarray, kind: str, packing: str) -> bytes:
    body = pixels.astype(TYPES[kind]).tobytes()
    return struct.pack(f">HH{len(width)}I", 0, len(width), *width) + (gzip.compress(body, mtime=0) if packing == "gzip" else body)


def _put(system, path: str, data: bytes) -> None:
    """A file that is there whole or not at all."""
    system.create_dir(path.rpartition("/")[0], recursive=True)
    target = WholeObject(system, path)
    try:
        target.stream.write(data)
        target.complete()
    finally:
        target.discard()


def write_container(chunks: DataFrame, root: str, axes, block, kind: str = "float32", packing: str = "gzip") -> None:
    """Chunk rows as a container. Tasks write the files, each whole; when all are there, an image gets its attributes, without
    which it counts as unfinished. A task that runs again writes the same files again."""
    axes, where = list(axes), qualified(chunks.sparkSession, root).rstrip("/")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(where)
        for batch in batches:
            for row in batch.to_pylist():
                place = [row[a + "0"] // b for a, b in zip(axes, block)]
                data = encoded([row["w" + a] for a in axes], np.array(row["data"]), kind, packing)
                _put(system, "/".join([top, row["image"], *map(str, place)]), data)
            yield pa.RecordBatch.from_pydict({"image": batch.column("image")})

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(where)
        for batch in batches:
            for row in batch.to_pylist():
                text = json.dumps({"dimensions": [row["n" + a] for a in axes], "blockSize": list(block), "dataType": kind, "compression": {"type": packing}})
                _put(system, f"{top}/{row['image']}/attributes.json", text.encode())
            yield pa.RecordBatch.from_pydict({"image": batch.column("image")})

    sizes = ["n" + a for a in axes]
    rows = chunks.select("image", *[a + "0" for a in axes], *["w" + a for a in axes], "data")
    rows.mapInArrow(files, "image string").write.format("noop").mode("overwrite").save()
    images = chunks.groupBy("image").agg(*[F.max(n).alias(n) for n in sizes])
    images.mapInArrow(described, "image string").write.format("noop").mode("overwrite").save()
