"""New folders for what a job writes and reads again, below the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A path that nothing has yet, below the session's spark.checkpoint.dir.

    Where that is unset a session in one process, as in tests, gets a temporary folder; a cluster gets an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4()}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that are written inside leave no shuffle files: Spark removes those of a query when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(rows: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """The rows written once, in a new folder by default, and read from their files."""
    spark, at = rows.sparkSession, at or folder(rows.sparkSession, name)
    with shuffles_dropped(spark):
        rows.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(rows.schema).parquet(at)


def dropped(spark: SparkSession, at: str) -> None:
    """Remove a folder that `folder` named, once nothing reads it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
