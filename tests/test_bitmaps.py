"""Distinct counts by bitmaps against sets, over many buckets, hot keys and days."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dayfold.operators import (
    count_bitmaps,
    merge_bitmaps,
    number_terms,
    rolling_distinct,
    term_bitmaps,
)

KINDS = "eid bigint, day date, term string"
DAY = date(2024, 1, 1)


def rows_of(seed):
    """A third of all rows have one key; null keys and null terms."""
    choose, rows = random.Random(seed), []
    for _ in range(3000):
        eid = choose.choice([1, None, choose.randrange(2, 30)])
        term = choose.choice([None, f"t{choose.randrange(400)}", f"u{choose.randrange(4000)}"])
        rows.append((eid, DAY + timedelta(days=choose.randrange(12)), term))
    return [*rows, (99, DAY, None)]


def sets(rows, key):
    found = defaultdict(set)
    for row in rows:
        found[key(row)] |= {row[2]} - {None}
    return {k: len(v) for k, v in found.items()}


def test_numbers_have_no_gaps_and_stay(spark):
    rows = rows_of(1)
    frame = spark.createDataFrame(rows, KINDS)
    early = number_terms(frame.where(F.col("day") < date(2024, 1, 5)), "term", "eid")
    first = dict(early.collect())
    whole = dict(number_terms(frame, "term", "eid", early).collect())
    assert sorted(whole.values()) == list(range(1, len(whole) + 1))
    assert whole.keys() == {r[2] for r in rows} - {None}
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    assert all(whole[term] == number for term, number in first.items())
    empty = number_terms(frame.limit(0), "term", "eid")
    assert empty.count() == 0 and number_terms(frame, "term", "eid", empty).count() == len(whole)


def test_counts_and_windows(spark):
    rows = rows_of(2)
    frame = spark.createDataFrame(rows, KINDS).repartition(5)
    numbers = number_terms(frame, "term", "eid")
    bitmaps = term_bitmaps(frame, ["eid", "day"], "term", numbers)
    assert dict(count_bitmaps(bitmaps, "eid").collect()) == sets(rows, lambda r: r[0])
    by_day = {(r[0], r[1]): r[2] for r in count_bitmaps(bitmaps, ["eid", "day"], "n").collect()}
    assert by_day == sets(rows, lambda r: (r[0], r[1]))
    # Bitmaps that were merged before give the same.
    assert dict(count_bitmaps(merge_bitmaps(bitmaps, "eid"), "eid").collect())[99] == 0
    for days in (1, 4):
        wide = [(r[0], r[1] + timedelta(days=i), r[2]) for r in rows for i in range(days)]
        wanted = {k: n for k, n in sets(wide, lambda r: (r[0], r[1])).items() if k in by_day}
        found = rolling_distinct(bitmaps, "eid", "day", days).collect()
        assert {(r[0], r[1]): r[2] for r in found} == wanted and len(found) == len(wanted)
    with pytest.raises(ValueError):
        rolling_distinct(bitmaps, "eid", "day", 0)


def test_many_buckets_of_one_key(spark):
    frame = spark.range(150_000).select(
        F.lit(1).alias("eid"), F.col("id").alias("term"), (F.col("id") % 3).alias("part")
    )
    numbers = number_terms(frame.unionByName(frame), "term", "eid")
    bitmaps = term_bitmaps(frame, ["eid", "part"], "term", numbers)
    assert merge_bitmaps(bitmaps, "eid").count() == 5
    assert [tuple(r) for r in count_bitmaps(bitmaps, "eid").collect()] == [(1, 150_000)]


def test_a_term_without_number_is_an_error(spark):
    frame = spark.createDataFrame(rows_of(3), KINDS)
    numbers = number_terms(frame.where("term < 't2'"), "term", "eid")
    with pytest.raises(PySparkException, match="no number"):
        term_bitmaps(frame, "eid", "term", numbers).collect()


def test_bitmaps_are_as_long_as_what_they_hold(spark):
    """Keys of two terms in far places take two words each, and no bitmap is a row of an aggregation."""
    frame = spark.range(4000).select(
        (F.col("id") % 2000).alias("eid"), F.col("id").alias("term"), F.lit(DAY).alias("day")
    )
    numbers = frame.select("term", (F.col("term") + 1).alias("number"))
    bitmaps = term_bitmaps(frame, ["eid", "day"], "term", numbers)
    assert bitmaps.select(F.max(F.size("bits")), F.sum(F.size("bits"))).first()[:] == (2, 4000)
    assert set(count_bitmaps(bitmaps, "eid").select("distinct_num").collect()) == {(2,)}
    for result in (count_bitmaps(bitmaps, "eid"), rolling_distinct(bitmaps, "eid", "day", 7)):
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_" not in plan.replace("bitmap_bit_position", "").replace(
            "bitmap_bucket_number", ""
        )
        assert "SortAggregate" not in plan
