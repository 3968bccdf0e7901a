"""Row-local steps: renames, ratios, tags, null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions.dates import require_day


def rename_column(frame: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column; a column that is not there is left alone."""
    return frame.withColumnRenamed(old, new)


def fill_zero(frame: DataFrame) -> DataFrame:
    """Null and NaN become 0 in every numeric column, the key included."""
    return frame.na.fill(0)


def drop_incomplete(frame: DataFrame) -> DataFrame:
    """Drop a row in which any column is null or NaN."""
    return frame.na.drop("any")


def add_ratios(frame: DataFrame, ratios: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add ``name = numerator / denominator`` for each (numerator, denominator, name).

    The result is a double, null where the denominator is 0.
    """
    return frame.withColumns(
        {name: F.try_divide(F.col(num), F.col(den)) for num, den, name in ratios}
    )


def tag_date(frame: DataFrame, dt: str, name: str = "actiondate") -> DataFrame:
    """Tag every row with the batch day, as text."""
    return frame.withColumn(name, F.lit(require_day(dt)))


def select_ordered(frame: DataFrame, first: Sequence[str]) -> DataFrame:
    """Columns in a fixed order: ``first``, then the others by name."""
    return frame.select(*first, *sorted(c for c in frame.columns if c not in first))


def preview_rows(frame: DataFrame, rows: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at: any, or the first by ``order_by``."""
    return (frame.orderBy(*order_by) if order_by else frame).limit(rows)
