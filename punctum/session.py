"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("punctum")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = os.environ.get("PUNCTUM_SCRATCH")
        if root is None:
            root = os.environ["PUNCTUM_SCRATCH"] = tempfile.mkdtemp(prefix="punctum-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is reused or overwritten."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on any file system Spark knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; local workers import it from the driver's path too."""
    context, root = spark.sparkContext, Path(__file__).resolve().parent
    name = f"{root.name}-{context.applicationId}.zip"
    if any(str(f).endswith(name) for f in context._jsc.sc().listFiles().mkString("\n").split("\n")):
        return
    folder = tempfile.mkdtemp(prefix="ship-")
    with zipfile.ZipFile(f"{folder}/{name}", "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(f"{folder}/{name}")


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, run after ``ship``."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        return query(spark, *rest)

    return run


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for results that several steps read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
