"""Grouped counts and sums.

All of it is partial aggregation before the shuffle, so a key that holds a large share of the
rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.operators.combine import Categories, combine_sources
from dayfold.sources.scans import Predicate, day_scan

# The type of products of counts.
COUNT = "decimal(38,0)"

Term = str | Column
Terms = Mapping[str, Term] | Sequence[Term]


def _aggregates(function: str, terms: Terms) -> list[Column]:
    """One aggregate per term: a column, or SQL text such as ``*`` or ``distinct session``."""

    def apply(term: Term) -> Column:
        if isinstance(term, str):
            return F.expr(f"{function}({term})")
        return F.count(term) if function == "count" else F.sum(term)

    if isinstance(terms, Mapping):
        return [apply(term).alias(name) for name, term in terms.items()]
    return [apply(term) for term in terms]


def group_metrics(
    frame: str | DataFrame,
    keys: Sequence[str] = ("eid",),
    counts: Terms = ("*",),
    sums: Terms = (),
    dt: str | None = None,
    where: Predicate | None = None,
) -> DataFrame:
    """Counts and sums per key in one pass.

    ``counts`` and ``sums`` map output names to terms; a plain sequence of terms leaves the
    names to Spark. ``dt`` restricts a table with a ``day`` column to one day.
    """
    rows = day_scan(frame, dt)
    if where is not None:
        rows = rows.where(where)
    aggregates = _aggregates("count", counts) + _aggregates("sum", sums)
    if not aggregates:
        return rows.select(*keys).distinct()
    return rows.groupBy(*keys).agg(*aggregates)


def category_sums(
    frame: DataFrame, key: str | Sequence[str], category: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """Sum of ``value`` per key with one output column per category, in one scan.

    ``names`` maps a category to its column. Keys that have none of the categories do not
    appear; a category that a key lacks is 0.
    """
    return combine_sources({category: Categories(frame, category, names, value)}, key)


def find_duplicates(frame: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, each once; null is a value like any other.

    Grouping long text would shuffle all of it, though most of it occurs once. So text is first
    counted by its hash, and only values whose hash occurs again are grouped by themselves. Spark
    chooses how to tell them apart by the size that the hashes turn out to have.
    """
    rows = frame.select(column)
    if rows.schema[column].dataType.typeName() in ("string", "binary"):
        hashed = F.xxhash64(column)
        again = rows.groupBy(hashed.alias("_hash")).count().where(F.col("count") > 1)
        rows = rows.join(again.select("_hash"), hashed == F.col("_hash"), "left_semi")
    return rows.groupBy(column).count().where(F.col("count") > 1).select(column)


def cross_join_count(frames: Sequence[DataFrame], name: str = "pairs") -> DataFrame:
    """Number of rows in the unrestricted product of ``frames``.

    It is the product of their row counts, so no pair is ever built: the inputs are reduced
    to nothing but a tag, and counted in one aggregation. The product is a decimal of 38 digits;
    beyond that it is an error.
    """
    tagged = reduce(
        DataFrame.unionByName,
        [frame.select(F.lit(i).alias("tag")) for i, frame in enumerate(frames)],
    )
    counts = [F.count(F.when(F.col("tag") == i, 1)) for i in range(len(frames))]
    product = reduce(
        lambda left, right: (left * right).cast(COUNT), [n.cast(COUNT) for n in counts]
    )
    return tagged.agg(product.alias(name))
