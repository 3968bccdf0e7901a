"""Joins of points to the ranges they lie in, whatever ordered type they have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of doubles as far as grids are concerned: half the largest one, since lengths are
# differences; a step that is no step; the bits of precision; and the outermost cell.
LARGEST = 2.0**1022
SMALLEST = 2.0**-1000
PRECISION = 52
OUTER = 2.0**61


def _axis(value: Column, kind: T.DataType) -> Column:
    """A double that never falls as the value rises; the exact comparison is made elsewhere."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # By calendar and clock: going through an instant would repeat hours where clocks go back.
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.extract(F.lit("SECOND"), value)
        return F.unix_date(value.cast("date")).cast("double") * 86400 + clock.cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    raise TypeError(f"a range join needs numbers, dates or timestamps, not {kind.simpleString()}")


def _common_type(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str) -> T.DataType:
    """The type that Spark compares the three columns in."""
    kinds = [points.schema[at].dataType, ranges.schema[low].dataType, ranges.schema[high].dataType]
    nulls = [F.lit(None).cast(kind) for kind in kinds]
    return points.sparkSession.range(0).select(F.coalesce(*nulls)).schema[0].dataType


def theta_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str) -> DataFrame:
    """Rows of ``points`` and ``ranges`` with ``low <= at < high``, without a nested loop.

    The columns are numbers, dates or timestamps, with or without zone, in any mixture that Spark
    can compare; other types are a ``TypeError``.

    A range goes to a grid whose cells are about as wide as itself, a power of two, where it
    touches two or three cells, however wide it is; a point goes to its cell in each grid that any
    range uses. They meet on grid and cell, and the exact bounds are checked on the pairs. A point
    lies in one cell of a grid and a range in one grid, so no pair comes twice.

    The grids in use are looked up first, by a job that runs when this is called: at most one for
    each power of two that a double can have. Nulls and NaN match nothing; infinite bounds are
    bounds. Equalities that the result is filtered by become keys of the same join.
    """
    kind = _common_type(points, ranges, at, low, high)
    bounds = [_axis(F.col(name).cast(kind), kind) for name in (low, high)]
    real = (F.col(low) < F.col(high)) & ~F.isnan(bounds[0]) & ~F.isnan(bounds[1])
    ends = [F.least(F.greatest(b, F.lit(-LARGEST)), F.lit(LARGEST)) for b in bounds]
    wide = F.ceil(F.log2(F.greatest(ends[1] - ends[0], F.lit(SMALLEST))))
    # Doubles have no finer steps than this at the range's place.
    fine = F.ceil(F.log2(F.greatest(F.abs(ends[0]), F.abs(ends[1]), F.lit(SMALLEST)))) - PRECISION
    gridded = ranges.where(real).withColumn("_grid", F.greatest(wide, fine).cast("int"))
    grids = sorted(row[0] for row in gridded.select("_grid").distinct().collect())

    def cell(value, grid):
        # An unbounded value lies in the outermost cells of a grid, as the bounds do.
        held = F.least(F.greatest(value, F.lit(-LARGEST)), F.lit(LARGEST))
        scaled = held / F.pow(F.lit(2.0), grid)
        return F.floor(F.least(F.greatest(scaled, F.lit(-OUTER)), F.lit(OUTER)))

    covered = gridded.withColumn(
        "_cell",
        F.explode(F.sequence(*[cell(b, F.col("_grid").cast("double")) for b in bounds])),
    )
    x = _axis(F.col(at).cast(kind), kind)
    located = points.where(x.isNotNull() & ~F.isnan(x)).withColumn(
        "_grid", F.explode(F.array(*[F.lit(g) for g in grids]).cast("array<int>"))
    )
    located = located.withColumn("_cell", cell(x, F.col("_grid").cast("double")))
    return (
        located.join(covered, ["_grid", "_cell"])
        .where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high)))
        .drop("_grid", "_cell")
    )
