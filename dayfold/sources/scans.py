"""Table scans.

Everything here only narrows a scan: the predicates are plain column comparisons with
literals, so they reach the reader as partition filters or pushed filters.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions.dates import day_bounds, require_day
from dayfold.ranges import theta_join

log = logging.getLogger(__name__)

Predicate = str | Column


def scan(
    table: str | DataFrame,
    columns: Sequence[str] = (),
    where: Predicate | None = None,
) -> DataFrame:
    """Read a table by name, with chosen columns (all when empty) and an optional predicate."""
    frame = SparkSession.active().table(table) if isinstance(table, str) else table
    if where is not None:
        frame = frame.where(where)
    return frame.select(*columns) if columns else frame


def day_scan(table: str | DataFrame, dt: str | None, day_column: str = "day") -> DataFrame:
    """One day of a table partitioned by a ``yyyyMMdd`` string; ``None`` means every day.

    The literal is a string, like the partition column, so that nothing is cast and the
    partition is pruned.
    """
    frame = scan(table)
    return frame if dt is None else frame.where(F.col(day_column) == F.lit(require_day(dt)))


def day_range_scan(table: str | DataFrame, dt: str | None, ts_column: str) -> DataFrame:
    """One day of a table that has a timestamp instead of a day partition.

    Written as a half-open range on the bare column, since a range is pushed to the file
    reader while a formatted timestamp is not.
    """
    frame = scan(table)
    if dt is None:
        return frame
    first, after = day_bounds(dt)
    kind = frame.schema[ts_column].dataType.typeName()
    return frame.where(
        (F.col(ts_column) >= F.lit(first).cast(kind)) & (F.col(ts_column) < F.lit(after).cast(kind))
    )


def multi_scan(
    tables: Sequence[str | DataFrame],
    where: Predicate | None = None,
    within: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Several tables related only by a predicate, as in a comma separated FROM.

    Equalities in ``where`` become hash or sort-merge join keys; what remains of it is
    checked on the joined rows. ``within`` is a range, as the columns (at, low, high) with
    ``low <= at < high``, that relates the table of the first to that of the others: numbers, dates
    or timestamps (see ``theta_join``), with or without equalities between the two. For the size of
    an unrestricted product use ``cross_join_count``. Tables that nothing connects are an error.
    """
    if not tables:
        raise ValueError("multi_scan needs at least one table")
    frames = [scan(t) for t in tables]
    if within is not None:
        points, ranges = (_one_with(frames, names) for names in (within[:1], within[1:]))
        if points is ranges:
            raise ValueError(f"{within} must relate two tables")
        others = [f for f in frames if f is not points and f is not ranges]
        frames = [theta_join(points, ranges, *within), *others]
    joined = reduce(lambda left, right: left.join(right), frames)
    if where is not None:
        joined = joined.where(where)
    planned = joined._jdf.queryExecution().sparkPlan().toString()
    if "CartesianProduct" in planned or "NestedLoopJoin" in planned:
        raise ValueError(f"neither an equality nor a range connects all of the tables: {where}")
    return joined


def _one_with(frames: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """The only frame with all of the columns."""
    found = [frame for frame in frames if set(names) <= set(frame.columns)]
    if len(found) != 1:
        raise ValueError(f"{len(found)} tables have the columns {', '.join(names)}")
    return found[0]


def query_view(frame: DataFrame, name: str, sql: str) -> DataFrame:
    """Register ``frame`` as temp view ``name`` and run ``sql`` against it."""
    frame.createOrReplaceTempView(name)
    return frame.sparkSession.sql(sql)


def load_or_none(load: Callable[[], DataFrame], label: str) -> DataFrame | None:
    """Run ``load``; a table, path or column that cannot be resolved gives ``None``.

    Only analysis can fail here, as nothing has been executed yet.
    """
    try:
        frame = load()
        frame.schema  # noqa: B018  forces analysis where it is lazy
    except AnalysisException as error:
        log.warning("no data loaded for %s: %s", label, error)
        return None
    return frame


def use_database(name: str) -> None:
    """Make ``name`` the current database; qualified table names are usually better."""
    SparkSession.active().catalog.setCurrentDatabase(name)
