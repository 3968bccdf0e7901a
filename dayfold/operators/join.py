"""Joins to dimensions; ``theta_join`` to ranges is in ``dayfold.ranges``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dayfold.ranges import theta_join

__all__ = ["attach_dimension", "theta_join"]


def attach_dimension(frame: DataFrame, dimension: DataFrame, key: str = "eid") -> DataFrame:
    """Inner join on ``key``, keeping one key column.

    No broadcast hint: Spark broadcasts the dimension when its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise merges on the key, where adaptive
    execution splits skewed partitions.
    """
    return frame.join(dimension, [key], "inner")
