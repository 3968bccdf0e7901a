"""The given tables, and the roles they play for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TYPES = ("click", "view", "signup", "purchase", "error")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_of(events: DataFrame, event_type: str) -> DataFrame:
    """One source: the events of a type."""
    return events.where(F.col("event_type") == event_type)


def enterprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension: customers, with the nation number as the number of users."""
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("eid"),
        F.col("c_name").alias("enterpriseaccount"),
        F.col("c_nationkey").alias("accountusedamount"),
    )
