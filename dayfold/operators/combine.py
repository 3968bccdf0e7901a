"""Bring the metrics of many sources into one row per key.

``outer_combine`` joins frames that are already one metric each. ``combine_sources`` starts
from the raw rows and gives the same result with one shuffle: every row is tagged with its
metric, the sources are put under one another, and one aggregation with a condition per
metric does the rest.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType

from dayfold.operators.clean import fill_zero
from dayfold.operators.split_join import split_outer_join

log = logging.getLogger(__name__)

_TAG = "_metric"
_NULL_TAG = "_null_metric"
_COUNTED = "_counted"
_TERM = "_term"


@dataclass(frozen=True)
class Metric:
    """One metric of one source: ``count``, ``count_distinct`` or ``sum`` of ``term``."""

    frame: DataFrame | None
    aggregate: str = "count"
    term: str | Column = "*"

    def __post_init__(self):
        if self.aggregate not in ("count", "count_distinct", "sum"):
            raise ValueError(f"unknown aggregate {self.aggregate!r}")
        if self.aggregate != "count" and isinstance(self.term, str) and self.term == "*":
            raise ValueError(f"{self.aggregate} needs a term")


@dataclass(frozen=True)
class Categories:
    """One source with a metric per category (``names``: category to metric), read once.

    Each metric is the sum of ``value`` over its category, or without a value the row count.
    """

    frame: DataFrame | None
    category: str
    names: Mapping[str, str]
    value: str | None = None


@dataclass(frozen=True)
class DistinctCounts:
    """One source with distinct counts of ``term`` over subsets of its rows, read once.

    ``names``: metric to the condition on rows that it counts. A (key, term) moves once, with the
    subsets that it occurs in, instead of once per metric.
    """

    frame: DataFrame | None
    term: str | Column
    names: Mapping[str, str | Column]


Source = DataFrame | Metric | Categories | DistinctCounts | None


def metric_names(sources: Mapping[str, Source]) -> list[str]:
    """The metrics that ``sources`` yield: one per entry, or one per category or subset."""

    def names_of(name: str, source: Source) -> list[str]:
        if isinstance(source, Categories):
            return list(source.names.values())
        return list(source.names) if isinstance(source, DistinctCounts) else [name]

    return [metric for name, source in sources.items() for metric in names_of(name, source)]


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _with_absent(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    return frame.withColumns({name: F.lit(0).cast("long") for name in names}) if names else frame


def _require_loaded(loaded: Sequence, absent: Sequence[str]) -> None:
    for name in absent:
        log.warning("no data for %s: its column will be 0", name)
    if not loaded:
        raise ValueError("none of the sources is available")


def outer_combine(
    frames: Mapping[str, DataFrame | None],
    key: str | Sequence[str] = "eid",
    unique_keys: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Full outer join of the frames on ``key``, numbers filled with 0.

    The mapping goes from metric name to frame; a metric whose frame is absent becomes a
    column of zeros. Null keys match nothing, so each stays a row of its own. Duplicate keys
    multiply, as in any join, and every join shuffles again.

    With ``unique_keys`` the frames must hold a key (and null) once each, as grouped frames do; a
    key that comes twice is an error. They are then combined by one aggregation, which takes a single
    shuffle, or none where all frames are already partitioned by the key.

    With ``hot_rows`` keys with more rows than that are counted first and cut up, so that no task
    gets one whole (see ``split_outer_join``).
    """
    keys = _keys(key)
    loaded = [frame for frame in frames.values() if frame is not None]
    absent = [name for name, frame in frames.items() if frame is None]
    _require_loaded(loaded, absent)
    if unique_keys:
        joined = _aligned(loaded, keys)
    elif hot_rows is not None:
        joined = split_outer_join(loaded, keys, hot_rows)
    else:
        joined = reduce(lambda left, right: left.join(right, keys, "outer"), loaded)
    return fill_zero(_with_absent(joined, absent))


def _aligned(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Frames with unique keys side by side: put under one another, one row per key."""
    rows = [
        frame.select(*keys, F.lit(i).alias(_TAG), *[c for c in frame.columns if c not in keys])
        for i, frame in enumerate(frames)
    ]
    results = []
    for i, frame in enumerate(frames):
        twice = F.count(F.when(F.col(_TAG) == i, 1)) > 1
        for field in frame.schema.fields:
            if field.name not in keys:
                error = F.raise_error(F.lit(f"a key comes twice with {field.name}"))
                results.append(
                    F.when(twice, error.cast(field.dataType))
                    .otherwise(F.max(_of(i, field.name)))
                    .alias(field.name)
                )
    return _per_key(_under_one_another(rows), keys, results)


def _per_key(rows: DataFrame, keys: Sequence[str], results: Sequence[Column]) -> DataFrame:
    """Aggregate tagged rows by key; rows with a null key only with those of their own tag."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    tagged = rows.withColumn(_NULL_TAG, F.when(any_null, F.col(_TAG)))
    return tagged.groupBy(*keys, _NULL_TAG).agg(*results).drop(_NULL_TAG)


def combine_sources(sources: Mapping[str, Source], key: str | Sequence[str] = "eid") -> DataFrame:
    """Group every source by ``key`` and combine the metrics, from raw rows, in one shuffle.

    Equal to grouping each source by itself and then ``outer_combine``. A bare frame counts
    its rows. Null keys keep apart per metric, because the metric is part of their group.

    Distinct counts add one shuffle, of no rows but theirs: they are first reduced to the
    distinct (key, metric, term), which also spreads a hot key over its terms.
    """
    keys = _keys(key)
    every = metric_names(sources)
    if len(set(every)) < len(every):
        raise ValueError(f"metrics must have different names: {every}")
    branches: list[_Branch] = []
    absent: list[str] = []
    tag = 0
    for name, source in sources.items():
        known = isinstance(source, (Metric, Categories, DistinctCounts))
        source = source if known else Metric(source)
        names = metric_names({name: source})
        if source.frame is None:
            absent += names
        elif isinstance(source, Categories):
            branches.append(_category_branch(source, keys, tag))
        elif isinstance(source, DistinctCounts):
            branches.append(_distinct_branch(source, keys, tag))
        else:
            branches.append(_metric_branch(name, source, keys, tag))
        tag += len(names)
    _require_loaded(branches, absent)

    plain = [b.rows for b in branches if not b.distinct]
    rows = _under_one_another(plain + _reduced([b.rows for b in branches if b.distinct], keys))
    combined = _per_key(rows, keys, [result for b in branches for result in b.results])
    return fill_zero(_with_absent(combined, absent))


@dataclass(frozen=True)
class _Branch:
    """Rows of one source, tagged with their metric, and the aggregates to take over all rows.

    The rows of a ``distinct`` branch carry a term, and still have to be reduced.
    """

    rows: DataFrame
    results: list[Column]
    distinct: bool = False


def _under_one_another(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _counted(term: Column) -> Column:
    return F.when(term.isNull(), 0).otherwise(1).cast("long").alias(_COUNTED)


def _reduced(frames: Sequence[DataFrame], keys: Sequence[str]) -> list[DataFrame]:
    """Distinct terms as rows to count; terms of one type share a shuffle."""
    by_type: dict[DataType, list[DataFrame]] = {}
    for frame in frames:
        by_type.setdefault(frame.schema[_TERM].dataType, []).append(frame)
    return [
        _under_one_another(alike).distinct().select(*keys, _TAG, _counted(F.col(_TERM)))
        for alike in by_type.values()
    ]


def _of(tag: int, column: str) -> Column:
    return F.when(F.col(_TAG) == tag, F.col(column))


def _sum_type(frame: DataFrame, value: str | Column) -> DataType:
    return frame.agg(F.sum(value)).schema[0].dataType


def _category_branch(source: Categories, keys: Sequence[str], first: int) -> _Branch:
    category = F.col(source.category)
    numbers = {c: first + i for i, c in enumerate(source.names)}
    pairs = [F.lit(item) for pair in numbers.items() for item in pair]
    tag = F.element_at(F.create_map(*pairs), category)
    if source.value is None:
        column, value, kind = _COUNTED, F.lit(1).cast("long"), LongType()
    else:
        column, value = f"_total_{first}", F.col(source.value)
        kind = _sum_type(source.frame, source.value)
    rows = source.frame.where(category.isin(list(numbers))).select(
        *keys, tag.alias(_TAG), value.alias(column)
    )
    results = [
        F.sum(_of(numbers[c], column)).cast(kind).alias(name) for c, name in source.names.items()
    ]
    return _Branch(rows, results)


def _distinct_branch(source: DistinctCounts, keys: Sequence[str], first: int) -> _Branch:
    conditions = [F.expr(c) if isinstance(c, str) else c for c in source.names.values()]
    tags = range(first, first + len(conditions))
    term = F.expr(source.term) if isinstance(source.term, str) else source.term
    flagged = source.frame.select(
        *keys,
        term.alias(_TERM),
        *[F.coalesce(c, F.lit(False)).alias(f"_in_{tag}") for tag, c in zip(tags, conditions)],
    )
    flags = [F.col(f"_in_{tag}") for tag in tags]
    terms = (
        flagged.where(reduce(lambda a, b: a | b, flags))
        .groupBy(*keys, _TERM)
        .agg(*[F.max(f"_in_{tag}").alias(f"_in_{tag}") for tag in tags])
    )
    found = F.array_compact(F.array(*[F.when(f, F.lit(tag)) for tag, f in zip(tags, flags)]))
    rows = terms.select(*keys, F.explode(found).alias(_TAG), _counted(F.col(_TERM)))
    results = [F.sum(_of(tag, _COUNTED)).alias(name) for tag, name in zip(tags, source.names)]
    return _Branch(rows, results)


def _metric_branch(name: str, metric: Metric, keys: Sequence[str], tag: int) -> _Branch:
    if isinstance(metric.term, Column):
        term = metric.term
    else:
        term = F.lit(1) if metric.term == "*" else F.expr(metric.term)

    def rows(value: Column) -> DataFrame:
        return metric.frame.select(*keys, F.lit(tag).alias(_TAG), value)

    if metric.aggregate == "sum":
        column = f"_total_{tag}"
        result = F.sum(_of(tag, column)).cast(_sum_type(metric.frame, term))
        return _Branch(rows(term.alias(column)), [result.alias(name)])
    result = F.sum(_of(tag, _COUNTED)).alias(name)
    if metric.aggregate == "count_distinct":
        return _Branch(rows(term.alias(_TERM)), [result], distinct=True)
    return _Branch(rows(_counted(term)), [result])
