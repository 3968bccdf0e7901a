"""The one-shuffle combine against the literal joins, on random rows with null keys."""

import random

import pytest
from pyspark.sql import functions as F

from dayfold.operators import (
    Categories,
    DistinctCounts,
    Metric,
    attach_dimension,
    category_sums,
    combine_sources,
    drop_incomplete,
    fill_zero,
    group_metrics,
    metric_names,
    outer_combine,
)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def same(left, right):
    assert left.dtypes == right.dtypes
    assert rows_of(left) == rows_of(right)


def random_rows(spark, seed, count=400):
    chooser = random.Random(seed)

    def row():
        return (
            chooser.choice([None, None, *range(12)]),
            chooser.choice([None, "x", "y"]),
            chooser.choice([None, *"TAILD"]),
            chooser.choice([None, *range(-3, 9)]),
            chooser.choice([None, "s1", "s2", "s3"]),
        )

    # One key holds a third of the rows.
    rows = [row() for _ in range(count)] + [(5, "x", "T", 1, f"s{i}") for i in range(count // 2)]
    return spark.createDataFrame(rows, "eid long, day string, kind string, n int, session string")


@pytest.mark.parametrize("keys", [["eid"], ["eid", "day"], ["day"]])
def test_counts(spark, keys):
    frames = {f"m{i}": random_rows(spark, i) for i in range(4)}
    frames["none"] = None
    literal = {
        name: frame if frame is None else group_metrics(frame, keys, {name: "*"})
        for name, frame in frames.items()
    }
    same(combine_sources(frames, keys), outer_combine(literal, keys))


@pytest.mark.parametrize("keys", [["eid"], ["eid", "day"]])
def test_unique_keys_in_one_shuffle(spark, keys):
    frames = {
        f"m{i}": group_metrics(random_rows(spark, i), keys, {f"m{i}": "*"}, {f"s{i}": "n"})
        for i in range(4)
    }
    frames["none"] = None
    same(outer_combine(frames, keys, unique_keys=True), outer_combine(frames, keys))


def test_unique_keys_are_checked(spark):
    a = spark.createDataFrame([(1, 10), (1, 20)], "eid long, a long")
    b = spark.createDataFrame([(1, 2)], "eid long, b long")
    with pytest.raises(Exception, match="a key comes twice with a"):
        outer_combine({"a": a, "b": b}, unique_keys=True).collect()


@pytest.mark.parametrize("keys", [["eid"], ["eid", "day"]])
def test_mixed_metrics(spark, keys):
    a, b, c, d = (random_rows(spark, seed) for seed in (11, 12, 13, 14))
    kinds = {"T": "t_sum", "A": "a_sum", "absent": "absent_sum"}
    combined = combine_sources(
        {
            "rows": Metric(a),
            "filled": Metric(a, "count", "session"),
            "sessions": Metric(b, "count_distinct", "session"),
            "numbers": Metric(c, "count_distinct", F.col("n") % 4),
            "total": Metric(b, "sum", "n"),
            "twice": Metric(b, "sum", F.col("n") * 2.0),
            "exact": Metric(b, "sum", "CAST(n AS decimal(10,2))"),
            "kinds": Categories(d, "kind", kinds, "n"),
            "counts": Categories(d, "kind", {"I": "i_num", "L": "l_num"}),
        },
        keys,
    )
    literal = {
        "rows": group_metrics(a, keys, {"rows": "*"}),
        "filled": group_metrics(a, keys, {"filled": "session"}),
        "sessions": group_metrics(b, keys, {"sessions": "distinct session"}),
        "numbers": group_metrics(c, keys, {"numbers": "distinct n % 4"}),
        "total": group_metrics(b, keys, (), {"total": "n"}),
        "twice": group_metrics(b, keys, (), {"twice": F.col("n") * 2.0}),
        "exact": group_metrics(b, keys, (), {"exact": "CAST(n AS decimal(10,2))"}),
        **{
            name: group_metrics(d.where(F.col("kind") == kind), keys, (), {name: "n"})
            for kind, name in kinds.items()
        },
        **{
            name: group_metrics(d.where(F.col("kind") == kind), keys, {name: "*"})
            for kind, name in (("I", "i_num"), ("L", "l_num"))
        },
    }
    same(combined, outer_combine(literal, keys))


def test_only_distinct_counts(spark):
    a, b = random_rows(spark, 21), random_rows(spark, 22)
    combined = combine_sources(
        {"x": Metric(a, "count_distinct", "session"), "y": Metric(b, "count_distinct", "session")}
    )
    literal = {
        "x": group_metrics(a, counts={"x": "distinct session"}),
        "y": group_metrics(b, counts={"y": "distinct session"}),
    }
    same(combined, outer_combine(literal))


@pytest.mark.parametrize("keys", [["eid"], ["eid", "day"]])
def test_distinct_counts_of_subsets(spark, keys):
    a, b = random_rows(spark, 31), random_rows(spark, 32)
    subsets = {"t": "kind = 'T'", "every": F.lit(True), "none": "n < -1e9"}
    combined = combine_sources(
        {
            "sets": DistinctCounts(a, "session", subsets),
            "numbers": DistinctCounts(b, F.col("n") % 4, {"small": F.col("n") < 3}),
            "rows": Metric(b),
            "gone": DistinctCounts(None, "session", {"x": "true", "y": "false"}),
        },
        keys,
    )
    literal = {
        "t": group_metrics(a.where("kind = 'T'"), keys, {"t": "distinct session"}),
        "every": group_metrics(a, keys, {"every": "distinct session"}),
        "none": group_metrics(a.where("n < -1e9"), keys, {"none": "distinct session"}),
        "small": group_metrics(b.where("n < 3"), keys, {"small": "distinct n % 4"}),
        "rows": group_metrics(b, keys, {"rows": "*"}),
        "x": None,
        "y": None,
    }
    same(combined, outer_combine(literal, keys))


def test_category_sums(spark):
    frame = random_rows(spark, 31)
    names = {k: f"seed{k.lower()}" for k in "TAI"}
    literal = {
        name: group_metrics(frame.where(F.col("kind") == kind), sums={name: "n"}, counts=())
        for kind, name in names.items()
    }
    same(category_sums(frame, "eid", "kind", "n", names), outer_combine(literal))


def test_null_keys(spark):
    a = spark.createDataFrame([(1, 10), (None, 5), (3, 7)], "eid long, a long")
    b = spark.createDataFrame([(1, 2), (None, 9), (4, 1)], "eid long, b long")
    expected = [(0, 0, 9), (0, 5, 0), (1, 10, 2), (3, 7, 0), (4, 0, 1)]
    assert rows_of(outer_combine({"a": a, "b": b})) == expected
    sums = {"a": Metric(a, "sum", "a"), "b": Metric(b, "sum", "b")}
    assert rows_of(combine_sources(sums)) == expected


def test_null_string_key_stays_null(spark):
    a = spark.createDataFrame([("1", 10), (None, 5)], "eid string, a long")
    b = spark.createDataFrame([("2", None)], "eid string, b long")
    expected = [("1", 10, 0), ("2", 0, 0), (None, 5, 0)]
    assert rows_of(outer_combine({"a": a, "b": b})) == expected


def test_duplicate_keys_multiply_in_the_literal_join(spark):
    a = spark.createDataFrame([(1, 10), (1, 20)], "eid long, a long")
    b = spark.createDataFrame([(1, 2)], "eid long, b long")
    assert rows_of(outer_combine({"a": a, "b": b})) == [(1, 10, 2), (1, 20, 2)]


def test_absent_sources(spark):
    a = spark.createDataFrame([(1, 10)], "eid long, a long")
    combined = outer_combine({"gone": None, "a": a})
    assert combined.dtypes == [("eid", "bigint"), ("a", "bigint"), ("gone", "bigint")]
    assert rows_of(combined) == [(1, 10, 0)]
    sources = {"gone": None, "a": a, "k": Categories(None, "kind", {"T": "t", "A": "u"}, "n")}
    assert metric_names(sources) == ["gone", "a", "t", "u"]
    assert rows_of(combine_sources(sources)) == [(1, 1, 0, 0, 0)]
    for combine in (outer_combine, combine_sources):
        with pytest.raises(ValueError, match="none of the sources"):
            combine({"a": None, "b": None})


def test_metric_arguments(spark):
    with pytest.raises(ValueError, match="median"):
        Metric(None, "median", "n")
    with pytest.raises(ValueError, match="needs a term"):
        Metric(None, "sum")


def test_metric_names_must_differ(spark):
    frame = random_rows(spark, 1, 5)
    with pytest.raises(ValueError, match="different names"):
        combine_sources({"a": frame, "k": Categories(frame, "kind", {"T": "a"})})


def test_group_metrics_forms(spark):
    frame = random_rows(spark, 41)
    unnamed = group_metrics(frame, ["eid"], ["*", "session"], ["n"])
    assert unnamed.columns == ["eid", "count(1)", "count(session)", "sum(n)"]
    assert group_metrics(frame).columns == ["eid", "count(1)"]
    day = group_metrics(frame.withColumn("day", F.lit("20240110")), counts={"c": "*"}, dt="20240111")
    assert day.count() == 0
    keys_only = group_metrics(frame, ["eid"], (), ())
    assert keys_only.count() == frame.select("eid").distinct().count()
    filtered = group_metrics(frame, ["kind"], {"c": "*"}, where="kind = 'T'")
    assert [r["kind"] for r in filtered.collect()] == ["T"]
    sums = spark.createDataFrame([(1, None), (None, 2)], "eid long, n long")
    assert rows_of(group_metrics(sums, sums={"s": "n"}, counts=())) == [(1, None), (None, 2)]


def test_attach_dimension_multiplies_duplicates(spark):
    counts = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "eid long, n long")
    dimension = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "eid long, ea string")
    assert rows_of(attach_dimension(counts, dimension)) == [(1, 10, "a"), (1, 10, "b")]


def test_fill_and_drop(spark):
    frame = spark.sql(
        "SELECT CAST(NULL AS decimal(10,2)) AS d, double('NaN') AS f, CAST(NULL AS float) AS g, "
        "CAST(NULL AS boolean) AS b, CAST(NULL AS date) AS t, CAST(NULL AS array<int>) AS a, "
        "CAST(NULL AS string) AS s"
    )
    row = fill_zero(frame).first()
    assert (float(row["d"]), row["f"], row["g"]) == (0.0, 0.0, 0.0)
    assert (row["b"], row["t"], row["a"], row["s"]) == (None, None, None, None)
    values = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None)], "k int, v double")
    assert rows_of(drop_incomplete(values)) == [(2, 1.0)]


@pytest.mark.parametrize("hot_rows", [1, 7, 10_000])
def test_split_outer_combine_equals_the_join(spark, hot_rows):
    draw = random.Random(hot_rows)

    def rows(number, keys):
        return [
            (draw.choice(keys), draw.choice([None, "x", "y"]), draw.randint(0, 5))
            for _ in range(number)
        ]

    frames = {
        "a": spark.createDataFrame(rows(60, [1, 1, 1, 2, 3, None]), "eid long, e2 string, a long"),
        "b": spark.createDataFrame(rows(40, [1, 1, 2, 2, 4, None]), "eid long, e2 string, b long"),
        "c": spark.createDataFrame(rows(10, [1, 5, None]), "eid long, e2 string, c long"),
        "gone": None,
    }
    keys = ["eid", "e2"]
    same(outer_combine(frames, keys, hot_rows=hot_rows), outer_combine(frames, keys))


def test_split_outer_combine_without_rows_or_with_clashing_columns(spark):
    a = spark.createDataFrame([(1, 10)] * 5 + [(None, 3)], "eid long, a long")
    b = spark.createDataFrame([], "eid long, b long")
    expected = sorted([(1, 10, 0)] * 5 + [(0, 3, 0)])
    for frames in ({"a": a, "b": b}, {"b": b, "a": a}):
        found = outer_combine(frames, hot_rows=2).select("eid", "a", "b")
        assert sorted(map(tuple, found.collect())) == expected
    with pytest.raises(ValueError, match="must differ"):
        outer_combine({"a": a, "b": a}, hot_rows=2)


def test_a_hot_key_of_an_outer_join_is_spread(spark):
    """A third of both sides has one key and one value; nulls are another third of the left one."""
    number = F.col("id")
    third = number % 3
    left = spark.range(0, 30_000, 1, 8).select(
        F.when(third == 0, 7).when(third == 1, number).alias("eid"), F.lit(1).alias("a")
    )
    right = spark.range(0, 300, 1, 8).select(
        F.when(third == 0, 7).otherwise(number + 20_000).alias("eid"), F.lit(2).alias("b")
    )
    before = {key: spark.conf.get(key, None) for key in SPREAD}
    for key, value in SPREAD.items():
        spark.conf.set(key, value)
    try:
        joined = outer_combine({"a": left, "b": right}, hot_rows=50)
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(row["count"] for row in tasks)
        assert sum(sizes) == joined.count() and sum(sizes) > 10_000 * 100
        large = [size for size in sizes if size > 1000]
        assert len(large) > 16 and large[-1] < 4 * large[len(large) // 2]
        whole = outer_combine({"a": left, "b": right})
        most = whole.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most >= 10_000 * 100 > 5 * sizes[-1]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SPREAD = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
}
