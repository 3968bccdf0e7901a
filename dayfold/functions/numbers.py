"""Integer functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Range of a 32-bit integer.
INT_MIN = -(2**31)
UINT_MASK = 2**32 - 1


def safe_abs(value: Column) -> Column:
    """Absolute value of an int, with 0 for the one int that has none."""
    return F.when(value == F.lit(INT_MIN), F.lit(0)).otherwise(F.abs(value))


def wrap_int(value: Column) -> Column:
    """The low 32 bits of a long, read as a signed int."""
    half = F.lit(2**31)
    return ((value + half).bitwiseAND(F.lit(UINT_MASK)) - half).cast("int")
