"""Shape of the physical plans: shuffles, scans, what reaches the reader."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from dayfold.queries import QUERIES
from dayfold.operators import (
    Categories,
    attach_dimension,
    category_sums,
    combine_sources,
    group_metrics,
    outer_combine,
    theta_join,
)
from dayfold.queries.tables import EVENT_TYPES, enterprise, events_of, read

SF_DIR = "/root/testdata/sf0.01"
SETTINGS = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def static(spark):
    """Plans as they are before anything has run, without broadcasts."""
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def count(frame, operator):
    return len(re.findall(rf"\b{operator}\b", plan(frame)))


def sources(spark):
    events = read(spark, SF_DIR, "events")
    return {f"{t}_num": events_of(events, t).selectExpr("user_id AS eid") for t in EVENT_TYPES}


def test_combining_raw_sources_shuffles_once(static):
    frames = sources(static)
    literal = outer_combine({n: group_metrics(f, counts={n: "*"}) for n, f in frames.items()})
    combined = combine_sources(frames)
    assert (count(literal, "Exchange"), count(literal, "SortMergeJoin")) == (8, 4)
    assert (count(combined, "Exchange"), count(combined, "SortMergeJoin")) == (1, 0)


def test_combining_grouped_frames_needs_no_shuffle_of_its_own(static):
    frames = {n: group_metrics(f, counts={n: "*"}) for n, f in sources(static).items()}
    combined = outer_combine(frames, unique_keys=True)
    assert (count(combined, "Exchange"), count(combined, "SortMergeJoin")) == (len(frames), 0)


def test_categories_are_read_once(static):
    events = read(static, SF_DIR, "events")
    names = {t: f"{t}_sum" for t in EVENT_TYPES}
    sums = category_sums(events, "user_id", "event_type", "value", names)
    assert (count(sums, "Exchange"), count(sums, "FileScan")) == (1, 1)
    assert "PushedFilters: [In(event_type" in plan(sums)
    counts = combine_sources({"all": Categories(events, "event_type", names)}, "user_id")
    assert (count(counts, "Exchange"), count(counts, "FileScan")) == (1, 1)
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan(counts)


def test_distinct_counts_shuffle_by_term_first(static):
    mix = driver.queries()["message_mix_table"](static, SF_DIR)
    assert (count(mix, "Exchange"), count(mix, "Expand")) == (2, 0)


def test_the_dimension_is_merged_when_it_is_not_small(static):
    counts = combine_sources(sources(static))
    joined = attach_dimension(counts, enterprise(static, SF_DIR))
    assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)


def test_day_range_is_pushed_and_columns_are_pruned(spark):
    scanned = plan(driver.queries()["day_scan"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", scanned)
    assert "value" not in scanned and "props" not in scanned


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_blindly_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    operators = ["CartesianProduct", "NestedLoop"]
    # Hashes and wide charsets are Arrow functions over whole batches.
    if not name.startswith("row_hash") and name != "bytes_to_text_wide":
        operators += ["Python", "MapInPandas", "Pandas"]
    for operator in operators:
        assert operator not in text


def test_null_key_rows_keep_their_own_group(spark):
    frame = spark.createDataFrame([(None,), (None,)], "eid long")
    combined = combine_sources({"a": frame, "b": frame.where(F.lit(True))})
    assert sorted(map(tuple, combined.collect())) == [(0, 0, 2), (0, 2, 0)]


SKEW_SETTINGS = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
}


def test_hot_points_are_split_in_a_theta_join(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        number = F.col("id")
        points = spark.range(0, 300_000, 1, 8).select(
            number, F.when(number % 3 == 0, 5.0).otherwise((number % 5000) * 1.0).alias("x")
        )
        ranges = spark.range(500).select(
            (number * 10.0).alias("low"), (number * 10.0 + 10.0).alias("high")
        )
        joined = theta_join(points, ranges, "x", "low", "high")
        assert len(joined.collect()) == 300_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
