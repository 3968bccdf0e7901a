"""Fresh directories in the folder that every executor can reach."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"
ASIDE = "_aside"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, or else under the warehouse.

    Both are folders that all executors share; a folder of this machine is never taken.
    """
    root = spark.conf.get(SETTING, None) or f"{spark.conf.get(WAREHOUSE).rstrip('/')}/{ASIDE}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_aside(
    frame: DataFrame, name: str, partitions: Sequence[str] = (), compression: str | None = None
) -> DataFrame:
    """Write a frame to a new path in the shared folder and go on from there.

    What follows is computed once, survives lost executors, and has a known size.
    """
    return write_to(frame, shared_path(frame.sparkSession, name), partitions, compression)


def write_to(
    frame: DataFrame, path: str, partitions: Sequence[str] = (), compression: str | None = None
) -> DataFrame:
    """As ``write_aside``, to a given new path, for whoever removes it afterwards."""
    log.info("writing to %s", path)
    writer = frame.write.partitionBy(*partitions)
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete exactly ``path``, through the file system it belongs to."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move_to_new(spark: SparkSession, path: str, target: str) -> bool:
    """Rename ``path`` to ``target`` in one step; False if there is one already."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, goal = fs.Path(path), fs.Path(target)
    files = fs.FileContext.getFileContext(
        goal.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        files.rename(source, goal, options)
    except Py4JJavaError:
        if files.util().exists(source) and files.util().exists(goal):
            return False
        raise
    return True


def folders_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Folders right under ``path``, with when they were changed last (seconds since 1970)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return {}
    found = files.listStatus(target)
    return {f.getPath().toString(): f.getModificationTime() // 1000 for f in found if f.isDirectory()}
