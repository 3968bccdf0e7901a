"""Whole files as rows."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.binary import bytes_to_text


def whole_files(path: str, charset: str = "UTF-8", pattern: str | None = None) -> DataFrame:
    """Every file under ``path`` as one row ``(path, text)``, decoded from ``charset``.

    Files are read in parallel, one row each, so a file is bounded by the size of a value
    (2 GB). An empty file has an empty text: the readers skip it, so its name is taken from the
    listing that they make. ``pattern`` is a file name glob.
    """
    spark = SparkSession.active()
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    texts = files.select("path", bytes_to_text(F.col("content"), charset).alias("text"))
    # The listing is there already; which of its files the reader skips is found out by Spark.
    listed = spark.createDataFrame([(unquote(name),) for name in files.inputFiles()], "path string")
    empty = listed.withColumn("_file", _plain(F.col("path"))).join(
        files.select(_plain(F.col("path")).alias("_file")), ["_file"], "left_anti"
    )
    return texts.unionByName(empty.select("path", F.lit("").alias("text")))


def _plain(path: Column) -> Column:
    """A path with one slash after its scheme, however many it is written with."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")
