"""A data source that lists the objects below a folder in tasks, not on the driver."""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "key string, size bigint, modified timestamp"
#: Schemes that tasks can list by themselves.
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
#: Folders that the driver looks for before it stops going deeper; it lists no more than ``LOOKED`` folders for that.
PREFIXES, LOOKED = 64, 128
ROWS = 10_000


class Prefix(InputPartition):
    """A folder, with all that is below it or only the objects right in it."""

    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class Objects(DataSource):
    """``key, size, modified`` of every object below ``path``; names that start with ``_`` or ``.`` are left out, as Spark's readers do.

    The driver opens a few folders to find prefixes to deal out; each task walks its prefixes folder by folder and hands rows on in
    batches. Empty and missing folders have no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "punctum_objects"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "ObjectsReader":
        return ObjectsReader(self.options["path"], int(self.options.get("prefixes", PREFIXES)))


class ObjectsReader(DataSourceReader):
    def __init__(self, root: str, prefixes: int):
        self.root, self.prefixes = root, prefixes

    def partitions(self) -> list[InputPartition]:
        system, root = opened(self.root)
        waiting, flat = deque([root]), []
        while waiting and len(waiting) < self.prefixes and len(flat) < LOOKED:
            flat.append(waiting.popleft())
            waiting.extend(folders(system, flat[-1]))
        return [Prefix(path, False) for path in flat] + [Prefix(path, True) for path in waiting]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        system, root = opened(self.root)
        start, waiting, rows = self.root.removesuffix("/"), [partition.path], []
        root = root.removesuffix("/")
        while waiting:
            for found in listed(system, waiting.pop()):
                if found.type == fs.FileType.Directory:
                    waiting += [found.path] if partition.deep else []
                    continue
                rows.append((start + found.path.removesuffix("/")[len(root) :], found.size, found.mtime))
                if len(rows) == ROWS:
                    yield batch_of(rows)
                    rows = []
        yield batch_of(rows)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified address, and the path in it."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a:", "s3:", 1))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as the session's file systems have it."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    return given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()


class WholeObject:
    """An object that is written under a hidden name and gets its own when it is complete."""

    def __init__(self, system: fs.FileSystem, path: str):
        folder, _, name = path.rpartition("/")
        self.system, self.path, self.part = system, path, f"{folder}/.{name}-{uuid.uuid4().hex}"
        self.stream = system.open_output_stream(self.part)

    def complete(self) -> str:
        self.stream.close()
        self.system.move(self.part, self.path)
        return self.path

    def discard(self) -> None:
        """Leave nothing, also of an object whose writing failed; one that is complete stays."""
        self.stream.close()
        if self.system.get_file_info(self.part).type != fs.FileType.NotFound:
            self.system.delete_file(self.part)


def listed(system: fs.FileSystem, path: str) -> Iterator[fs.FileInfo]:
    """What is right in a folder, without hidden names."""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return (f for f in found if not f.base_name.startswith(("_", ".")))


def folders(system: fs.FileSystem, path: str) -> list[str]:
    return sorted(f.path for f in listed(system, path) if f.type == fs.FileType.Directory)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    keys, sizes, times = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sizes, pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))], names=["key", "size", "modified"])
