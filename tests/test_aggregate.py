"""Lists, duplicates and range joins against brute force, with hot keys."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
import xxhash
from pyspark.sql import functions as F

from dayfold.operators import (
    collect,
    cross_join_count,
    find_duplicates,
    group_collect,
    preview_rows,
    theta_join,
)
from dayfold.sinks.shared import write_aside
from dayfold.sources import multi_scan


def tie(value):
    """The hash that decides between rows of the same order."""
    digest = 42 if value is None else xxhash.xxh64(value.encode(), seed=42).intdigest()
    return digest - 2**64 if digest >= 2**63 else digest


def brute_lists(rows, part_rows):
    """Rows (key, order, value): newest first, nulls last, ties by hash and value."""
    groups = defaultdict(list)
    for key, order, value in rows:
        groups[key].append((order is not None, order or 0, tie(value), value))
    lists = {}
    for key, items in groups.items():
        values = [item[3] for item in sorted(items, key=lambda item: item[:3], reverse=True)]
        for start in range(0, len(values), part_rows):
            lists[key, start // part_rows] = values[start : start + part_rows]
    return lists


def collected(frame, **arguments):
    parts = group_collect(frame, "k", "v", "o", **arguments)
    return {(r["k"], r["part"]): r["values"] for r in parts.collect()}


def hot_rows(seed, order):
    chooser = random.Random(seed)
    rows = [("hot", order(i), f"h{i}") for i in range(400)]
    rows += [(chooser.choice([None, *"abcdef"]), order(i + 1000), f"v{i}") for i in range(800)]
    rows += [("a", None, "n1"), ("a", None, "n2"), ("b", order(5), None), ("hot", None, "n3")]
    chooser.shuffle(rows)
    return rows


@pytest.mark.parametrize("part_rows", [1, 7, 100, 5000])
def test_group_collect_hot_key(spark, part_rows):
    rows = hot_rows(1, lambda i: i * i)
    frame = spark.createDataFrame(rows, "k string, o long, v string").repartition(7)
    assert collected(frame, part_rows=part_rows) == brute_lists(rows, part_rows)


def test_group_collect_many_large_keys(spark):
    rows = hot_rows(6, lambda i: i)
    frame = spark.createDataFrame(rows, "k string, o long, v string")
    assert collected(frame, part_rows=30) == brute_lists(rows, 30)


def test_group_collect_numbers_only_large_groups(spark):
    rows = hot_rows(7, lambda i: i)
    frame = spark.createDataFrame(rows, "k string, o long, v string")
    assert collected(frame, part_rows=200) == brute_lists(rows, 200)


@pytest.mark.parametrize("kind", ["int", "double", "decimal(20,2)"])
@pytest.mark.parametrize("orders", [1, 3, 40])
def test_group_collect_ties(spark, kind, orders):
    rows = hot_rows(2, lambda i: i % orders)
    frame = spark.createDataFrame(rows, "k string, o int, v string").repartition(5)
    frame = frame.withColumn("o", F.col("o").cast(kind))
    assert collected(frame, part_rows=50) == brute_lists(rows, 50)


def test_group_collect_orders_beyond_doubles(spark):
    rows = hot_rows(8, lambda i: 2**62 + i % 50)
    frame = spark.createDataFrame(rows, "k string, o long, v string").repartition(5)
    assert collected(frame, part_rows=50) == brute_lists(rows, 50)


@pytest.mark.parametrize(
    ("kind", "order"),
    [
        ("timestamp", lambda i: datetime(2024, 1, 1) + timedelta(seconds=i)),
        ("timestamp_ntz", lambda i: datetime(2024, 1, 1) + timedelta(seconds=i)),
        ("date", lambda i: date(2020, 1, 1) + timedelta(days=i)),
        ("double", lambda i: i / 7),
    ],
)
def test_group_collect_order_types(spark, kind, order):
    rows = hot_rows(3, lambda i: i)
    frame = spark.createDataFrame(
        [(k, None if o is None else order(o), v) for k, o, v in rows], f"k string, o {kind}, v string"
    )
    assert collected(frame, part_rows=60) == brute_lists(rows, 60)


def test_group_collect_edges(spark):
    empty = spark.createDataFrame([], "k string, o long, v string")
    assert collected(empty) == {}
    assert collected(empty, part_rows=1) == {}
    unordered = spark.createDataFrame([("a", None, "x"), ("a", None, "y")], "k string, o long, v string")
    assert collected(unordered, part_rows=1) == brute_lists([("a", None, "x"), ("a", None, "y")], 1)
    texts = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y")], "k string, o string, v string")
    assert collected(texts) == {("a", 0): ["y", "x"]}
    assert collected(texts, part_rows=1) == {("a", 0): ["y"], ("a", 1): ["x"]}


def most_in_a_range(spark, frame, monkeypatch):
    """Lists in parts of 50, and the largest number of rows that one range held."""
    aside = []

    def keep(rows, name):
        aside.append(write_aside(rows, name))
        return aside[-1]

    monkeypatch.setattr(collect, "write_aside", keep)
    lists = collected(frame, part_rows=50)
    ranges = aside[0].groupBy(F.shiftright("_row", collect.ROW_BITS)).count()
    return lists, ranges.agg(F.max("count")).first()[0]


@pytest.mark.parametrize(
    ("kind", "rows"),
    [
        ("long", [(f"k{i % 20}", 1000 * (i % 20) + i // 20, f"v{i}") for i in range(8000)]),
        ("decimal(20,2)", [("hot", Decimal(7), f"v{i}") for i in range(8000)]),
        ("long", [("hot", 2**60 + 1, f"v{i}") for i in range(8000)]),
        ("long", [("hot", 7, "same") for _ in range(8000)]),
        ("string", [("hot", f"o{i:05d}", "v") for i in range(8000)]),
    ],
)
def test_group_collect_spreads_every_kind_of_hot_rows(spark, monkeypatch, kind, rows):
    monkeypatch.setattr(collect, "write_aside", write_aside)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, f"k string, o {kind}, v string").repartition(4)
        lists, most = most_in_a_range(spark, frame, monkeypatch)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert lists == brute_lists(rows, 50)
    assert most <= 2 * len(rows) / 8


@pytest.mark.parametrize(("rows", "part_rows"), [(160_000, 100), (400_000, 10_000)])
def test_group_collect_one_key_makes_no_long_array(spark, rows, part_rows):
    """Neither the result nor anything before it lists more than a part."""
    frame = spark.range(0, rows, 1, 8).select(
        F.lit("hot").alias("k"), F.col("id").alias("o"), F.col("id").alias("v")
    )
    parts = group_collect(frame, "k", "v", "o", part_rows)
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert "flatten" not in text and "slice" not in text and "Generate" not in text
    sizes = parts.agg(
        F.max(F.size("values")).alias("most"),
        F.count("*").alias("parts"),
        F.count_if(F.col("values")[0] != rows - 1 - F.col("part") * part_rows).alias("misplaced"),
        F.count_if(
            F.col("values")[F.size("values") - 1] != rows - F.col("part") * part_rows - F.size("values")
        ).alias("disordered"),
    )
    assert sizes.first() == (part_rows, rows // part_rows, 0, 0)


def test_group_collect_null_keys_are_cut_like_others(spark):
    rows = [(None, i, f"v{i}") for i in range(1000)] + [("a", i, f"v{i}") for i in range(30)]
    frame = spark.createDataFrame(rows, "k string, o long, v string").repartition(4)
    lists = collected(frame, part_rows=100)
    assert lists.keys() == {(None, part) for part in range(10)} | {("a", 0)}
    assert lists[None, 3] == [f"v{999 - i}" for i in range(300, 400)]


def test_group_collect_two_keys(spark):
    frame = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    frame = frame.withColumn("j", F.lit("j"))
    for part_rows, expected in ((10, [(1, "j", 0, ["b", "a"]), (2, "j", 0, ["c"])]),
                                (1, [(1, "j", 0, ["b"]), (1, "j", 1, ["a"]), (2, "j", 0, ["c"])])):
        rows = group_collect(frame, ["k", "j"], "v", "o", part_rows).collect()
        assert sorted(map(tuple, rows)) == expected


def test_find_duplicates(spark):
    chooser = random.Random(5)
    values = [None, None, "", "", "once", "a", "a"] + ["copied"] * 300
    values += [f"t{chooser.randrange(500)}" for _ in range(600)]
    expected = {v for v in values if values.count(v) > 1}
    frame = spark.createDataFrame([(v, 1) for v in values], "v string, n int").repartition(6)
    found = [r[0] for r in find_duplicates(frame, "v").collect()]
    assert len(found) == len(expected) and set(found) == expected
    assert [r[0] for r in find_duplicates(frame, "n").collect()] == [1]


def test_theta_join(spark):
    chooser = random.Random(4)
    points = [(i, chooser.choice([-5.0, 3.0, 3.0, 3.0, chooser.uniform(-30, 60)])) for i in range(600)]
    points += [(9999, None), (9998, float("nan"))]
    bounds = [(f"r{i}", low := chooser.uniform(-40, 50), low + chooser.uniform(-2, 25)) for i in range(40)]
    bounds += [("edge", 3.0, 3.5), ("empty", 3.0, 3.0), ("null", None, 9.0)]
    expected = sorted(
        (p, r)
        for p, x in points
        for r, low, high in bounds
        if x is not None and low is not None and low <= x < high
    )
    left = spark.createDataFrame(points, "p int, x double")
    right = spark.createDataFrame(bounds, "r string, low double, high double")
    joined = theta_join(left, right, "x", "low", "high").select("p", "r")
    assert sorted(map(tuple, joined.collect())) == expected
    assert theta_join(left, right.limit(0), "x", "low", "high").count() == 0


def test_theta_join_of_ranges_of_all_widths(spark):
    """One range over the whole domain, infinite ones and tiny ones at large values."""
    inf = float("inf")
    points = [0.0, -1e300, 1e18, 1e18 + 256, 7.5, 1e-9, 5e-324, inf]
    bounds = [
        (-1e308, 1e308), (-inf, inf), (0.0, inf), (7.0, 8.0), (0.0, 1e-8), (1e18, 1e18 + 200),
        (0.0, 1e-323), (2.0**40, 2.0**41), (7.5, 7.500000001),
    ]
    expected = sorted((p, *b) for p in points for b in bounds if b[0] <= p < b[1])
    left = spark.createDataFrame([(p,) for p in points], "x double")
    right = spark.createDataFrame(bounds, "low double, high double")
    joined = theta_join(left, right, "x", "low", "high").select("x", "low", "high")
    assert sorted(map(tuple, joined.collect())) == expected
    assert theta_join(
        spark.createDataFrame([(2**62 + 1,)], "x long"),
        spark.createDataFrame([(2**62, 2**62 + 2), (2**62 + 2, 2**62 + 9)], "low long, high long"),
        "x", "low", "high",
    ).count() == 1


def test_scans_that_nothing_connects_are_refused(spark):
    left, right = spark.range(3).toDF("a"), spark.range(3).toDF("b")
    with pytest.raises(ValueError, match="equality"):
        multi_scan([left, right], "a < b")
    assert multi_scan([left, right], "a = b AND a < 2").count() == 2


def test_cross_join_count(spark):
    frames = [spark.range(n) for n in (3, 5, 7)]
    assert cross_join_count(frames).collect() == [(105,)]
    assert cross_join_count([spark.range(4), spark.range(0)], "n").collect() == [(0,)]


def test_preview_rows(spark):
    frame = spark.range(100)
    assert preview_rows(frame).count() == 10
    assert [r[0] for r in preview_rows(frame, 3, ["id"]).collect()] == [0, 1, 2]


NEW_YORK = "America/New_York"


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        ("date", lambda i: date(1960, 1, 1) + timedelta(days=97 * i)),
        ("timestamp", lambda i: datetime(2024, 11, 2, 20) + timedelta(minutes=10 * i)),
        ("timestamp_ntz", lambda i: datetime(2024, 11, 2, 20) + timedelta(minutes=10 * i)),
        ("timestamp_ntz", lambda i: datetime(1960, 1, 1) + timedelta(microseconds=i)),
        ("decimal(30,10)", lambda i: Decimal(i) / 8 + Decimal(10) ** 18),
        ("long", lambda i: 2**62 + i),
        ("byte", lambda i: i - 40),
    ],
)
def test_theta_join_of_every_ordered_type(spark, kind, value):
    draw = random.Random(3)
    points = [(i, None if i % 11 == 0 else value(draw.randint(0, 60))) for i in range(80)]
    ends = [sorted((draw.randint(0, 60), draw.randint(0, 60))) for _ in range(40)]
    ranges = [(i, value(a), None if i == 5 else value(b)) for i, (a, b) in enumerate(ends)]
    expected = sorted(
        (p, r)
        for p, x in points
        for r, low, high in ranges
        if x is not None and high is not None and low <= x < high
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", NEW_YORK)
    try:
        left = spark.createDataFrame(points, f"p int, x {kind}")
        right = spark.createDataFrame(ranges, f"r int, low {kind}, high {kind}")
        joined = theta_join(left, right, "x", "low", "high").select("p", "r")
        assert sorted(map(tuple, joined.collect())) == expected and expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_theta_join_of_mixed_and_unordered_types(spark):
    left = spark.sql("SELECT timestamp_ntz'2024-03-05 12:00:00' AS x, 'a' AS name")
    right = spark.sql("SELECT date'2024-03-05' AS low, date'2024-03-06' AS high, 'b' AS z")
    assert theta_join(left, right, "x", "low", "high").count() == 1
    with pytest.raises(TypeError, match="string"):
        theta_join(left, right, "name", "z", "z")
