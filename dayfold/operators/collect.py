"""Lists per key, bounded in size whatever the key holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.sinks.shared import write_aside

# Ids of rows count up from a multiple of 2 to this power in each range.
ROW_BITS = 33


def group_collect(
    frame: DataFrame,
    key: str | Sequence[str],
    value: str,
    order: str,
    part_rows: int = 10_000,
    name: str = "values",
) -> DataFrame:
    """Values per key in reverse arrival order, where ``order`` tells the arrival.

    Gives rows (key, part, values): an array holds at most ``part_rows`` values, and the whole
    list of a key is its parts one after another. Most keys have the single part 0. A part is
    one value of a row, so choose ``part_rows`` smaller where single values are large.

    Rows of a key with the same order go by the hash of their value, then by value; rows without
    an order come last. Any order, key and value that Spark can sort will do.

    The rows are dealt out by ranges of (key, order, hash, value, row), sorted there and written
    aside, numbered in that order. The ranges follow the real distribution of all of these, so a
    key, an order or a value that comes ever so often is spread over as many ranges as its rows
    fill. Only keys with more rows than a part need more than that: a row's place in its list is its
    number, less that of the first row of its key in the range, plus the rows that earlier ranges
    hold of the key. Rows are then listed by key and part, so no array is ever longer than a part.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = frame.select(
        F.struct(*keys).alias("_key"),
        F.col(order).alias("_order"),
        F.col(value).alias("_value"),
        F.xxhash64(value).alias("_tie"),
        # Tells equal rows apart, so that they can lie in different ranges.
        F.monotonically_increasing_id().alias("_copy"),
    )
    sorting = [
        F.col("_key").asc(),
        F.col("_order").desc_nulls_last(),
        F.col("_tie").desc(),
        F.col("_value").desc_nulls_last(),
        F.col("_copy").asc(),
    ]
    placed = (
        rows.repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .select("_key", "_value", F.monotonically_increasing_id().alias("_row"))
    )
    written = write_aside(placed, "lists").withColumn("_range", F.shiftright("_row", ROW_BITS))
    long = write_aside(_long_lists(written, part_rows), "list-starts")
    # Of known size, as it is written: Spark copies it to all tasks only where it is small.
    short = written.join(long.select("_key"), ["_key"], "left_anti")
    numbered = written.join(long, ["_key", "_range"]).withColumn(
        "part", F.expr(f"(_row + _shift) div {part_rows}")
    )
    lists = _listed(short.withColumn("part", F.lit(0).cast("long"))).unionByName(_listed(numbered))
    return lists.select("_key.*", "part", F.col("_values").alias(name))


def _long_lists(written: DataFrame, part_rows: int) -> DataFrame:
    """(_key, _range, _shift) of keys with more rows than a part: from a row's number to its place."""
    counts = written.groupBy("_key", "_range").agg(
        F.count("*").alias("_rows"), F.min("_row").alias("_first")
    )
    whole = Window.partitionBy("_key")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("_all", F.sum("_rows").over(whole))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .where(F.col("_all") > part_rows)
        .select("_key", "_range", (F.col("_before") - F.col("_first")).alias("_shift"))
    )


def _listed(rows: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("_row", "_value")))
    values = F.transform(listed, lambda row: row["_value"])
    return rows.groupBy("_key", "part").agg(values.alias("_values"))
