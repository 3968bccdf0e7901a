"""Batch dates in the compact ``yyyyMMdd`` form."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a batch date.
DAY_FORMAT = "yyyyMMdd"


def require_day(dt: str) -> str:
    """Return ``dt`` if it is a calendar day written with eight digits, else raise."""
    if not re.fullmatch(r"[0-9]{8}", dt):
        raise ValueError(f"expected a day as {DAY_FORMAT}, got {dt!r}")
    datetime.strptime(dt, "%Y%m%d")
    return dt


def day_bounds(dt: str) -> tuple[str, str]:
    """First instant of a day and of the next one, as timestamp text."""
    first = datetime.strptime(require_day(dt), "%Y%m%d").date()
    return f"{first} 00:00:00", f"{first + timedelta(days=1)} 00:00:00"


def resolve_batch_date(args: Sequence[str] = (), today: date | None = None) -> str:
    """The day a job runs for: its first argument, else yesterday in local time."""
    if args:
        return require_day(args[0])
    return ((today or date.today()) - timedelta(days=1)).strftime("%Y%m%d")


def compact_day(day: Column) -> Column:
    """A date or timestamp as ``yyyyMMdd`` text.

    The cast to a date comes first, which keeps timestamps without zone out of the session
    time zone.
    """
    return F.date_format(day.cast("date"), DAY_FORMAT)


def batch_date(day: Column) -> Column:
    """The day before ``day`` as ``yyyyMMdd`` text."""
    return compact_day(F.date_sub(day.cast("date"), 1))
