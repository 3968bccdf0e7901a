"""Full outer joins whose frequent keys are cut up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.sinks.shared import write_aside

_COUNT = "_rows_{}"


def split_outer_join(frames: Sequence[DataFrame], keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Full outer join of all frames on ``keys``, where no task gets a frequent key whole.

    A full outer join cannot be split by adaptive execution, as no part of a key's rows knows
    whether another part has met a partner. But whether a key is in a frame is known once its rows
    are counted. So keys with more than ``hot_rows`` rows, in a frame or in the join of some, are
    taken out: a frame without such a key gets one row of nulls for it, and what is left is inner
    joins, in which both sides are dealt out over a grid of cells, with about ``hot_rows`` rows of
    each side in a cell. Rows with a null key match nothing and are not joined at all. All other
    rows are joined as ever.

    Frames must not share columns other than the keys. Frequent keys and their rows are written
    aside, so that how rows are dealt out is the same when a task runs again.
    """
    names = [c for frame in frames for c in frame.columns if c not in keys]
    if len(set(names)) < len(names):
        raise ValueError(f"columns other than the keys must differ: {names}")
    no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    hot = write_aside(_hot_keys(frames, keys, no_null, hot_rows), "hot-keys")
    plain = [frame.where(no_null).join(hot.select(*keys), list(keys), "left_anti") for frame in frames]
    lonely = [frame.where(~no_null) for frame in frames]
    joined = [
        reduce(lambda a, b: a.join(b, list(keys), "outer"), plain),
        _hot_join(frames, keys, hot, hot_rows),
        *lonely,
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), joined)
    return rows.select(*keys, *names)


def _hot_keys(
    frames: Sequence[DataFrame], keys: Sequence[str], no_null: Column, hot_rows: int
) -> DataFrame:
    """(keys, rows per frame) of keys with more rows than ``hot_rows`` somewhere on the way.

    Every such key has that many rows in a frame, or a product of frames: few keys do.
    """
    counts = [
        frame.where(no_null).groupBy(*keys).agg(F.count("*").alias(_COUNT.format(i)))
        for i, frame in enumerate(frames)
    ]
    side_by_side = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    columns = [_COUNT.format(i) for i in range(len(frames))]
    per_key = side_by_side.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns]
    )
    # The join only grows: its last number of rows is the largest, and no frame has more.
    most = reduce(lambda a, b: a * b, [F.greatest(F.col(c), F.lit(1)).cast("double") for c in columns])
    return per_key.where(most > hot_rows)


def _cells(rows: Column, hot_rows: int) -> Column:
    return F.ceil(rows / F.lit(hot_rows)).cast("int")


def _hot_join(
    frames: Sequence[DataFrame], keys: Sequence[str], hot: DataFrame, hot_rows: int
) -> DataFrame:
    """All combinations of the rows that the frames have of the hot keys."""
    so_far, joined = F.lit(1.0), None
    for i, frame in enumerate(frames):
        count = F.greatest(F.col(_COUNT.format(i)), F.lit(1)).cast("double")
        if joined is None:
            joined = _rows_of(frame, keys, hot, i)
        else:
            left, right = _cells(so_far, hot_rows), _cells(count, hot_rows)
            joined = _dealt(joined, keys, hot, left, right, "_left", "_right").join(
                _dealt(_rows_of(frame, keys, hot, i), keys, hot, right, left, "_right", "_left"),
                [*keys, "_left", "_right"],
            )
            joined = joined.drop("_left", "_right")
            if i + 1 < len(frames):
                joined = write_aside(joined, "hot-rows")
        so_far = so_far * count
    return joined


def _rows_of(frame: DataFrame, keys: Sequence[str], hot: DataFrame, i: int) -> DataFrame:
    """A frame's rows of hot keys, or one row of nulls for a key that it does not have."""
    there = frame.join(hot.select(*keys), list(keys))
    absent = hot.where(F.col(_COUNT.format(i)) == 0).select(*keys)
    return write_aside(there.unionByName(absent, allowMissingColumns=True), "hot-rows")


def _dealt(
    rows: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    own: Column,
    others: Column,
    own_name: str,
    other_name: str,
) -> DataFrame:
    """Each row in one of its side's ``own`` cells, once for each of the ``others``.

    ``rows`` are read from files, so their numbers are the same whenever a task runs.
    """
    counted = rows.join(hot, list(keys))
    number = F.xxhash64(F.monotonically_increasing_id())
    dealt = counted.withColumn(own_name, F.pmod(number, own.cast("long")).cast("int")).withColumn(
        other_name, F.explode(F.sequence(F.lit(0), others - 1))
    )
    return dealt.select(*rows.columns, own_name, other_name)
