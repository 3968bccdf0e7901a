"""Scans, tolerant loads, whole files."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dayfold.sources import (
    day_range_scan,
    day_scan,
    load_or_none,
    multi_scan,
    query_view,
    scan,
    use_database,
    whole_files,
)


@pytest.fixture
def days(spark):
    frame = spark.createDataFrame(
        [("20240109", 1), ("20240110", 2), ("20240110", 3), ("bad", 4), (None, 5)],
        "day string, eid long",
    )
    frame.createOrReplaceTempView("days")
    return frame


def ids(frame):
    return sorted(r["eid"] for r in frame.collect())


def test_scan(spark, days):
    assert scan("days").columns == ["day", "eid"]
    assert scan("days", ["eid"]).columns == ["eid"]
    assert ids(scan("days", ["eid"], "day = 'bad' OR eid < 2")) == [1, 4]
    assert ids(scan(days, where=F.col("eid") > 3)) == [4, 5]


def test_day_scan_compares_text(days):
    assert ids(day_scan("days", "20240110")) == [2, 3]
    assert ids(day_scan("days", None)) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        day_scan("days", "2024-01-10")
    with pytest.raises(ValueError):
        day_scan("days", "")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_day_range_scan(spark, kind):
    frame = spark.sql(
        "SELECT eid, CAST(t AS timestamp_ntz) AS ts FROM VALUES (1, '2024-01-09 23:59:59.999999'), "
        "(2, '2024-01-10 00:00:00'), (3, '2024-01-10 23:59:59.999999'), (4, '2024-01-11 00:00:00'), "
        "(5, NULL) AS v(eid, t)"
    ).withColumn("ts", F.col("ts").cast(kind))
    assert ids(day_range_scan(frame, "20240110", "ts")) == [2, 3]
    assert ids(day_range_scan(frame, None, "ts")) == [1, 2, 3, 4, 5]


def test_partition_is_pruned(spark, days, tmp_path):
    days.where("day IS NOT NULL").write.partitionBy("day").parquet(str(tmp_path / "t"))
    frame = spark.read.schema("eid long, day string").parquet(str(tmp_path / "t"))
    scanned = day_scan(frame, "20240110")
    assert ids(scanned) == [2, 3]
    assert len(scanned.inputFiles()) > 0
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "= 20240110)]" in plan


def test_multi_scan(spark, days):
    spark.createDataFrame([(2, "b"), (3, "c"), (9, "z")], "id long, name string").createOrReplaceTempView("names")
    joined = multi_scan(["days", "names"], "eid = id AND name > 'b'")
    assert [(r["eid"], r["name"]) for r in joined.collect()] == [(3, "c")]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert ids(multi_scan(["days"], "eid = 1")) == [1]
    with pytest.raises(ValueError):
        multi_scan([], "eid = 1")


def test_query_view(spark, days):
    result = query_view(days, "registered", "SELECT max(eid) AS m FROM registered")
    assert result.collect() == [(5,)]


def test_load_or_none(spark, days, tmp_path):
    assert load_or_none(lambda: scan("days"), "days") is not None
    assert load_or_none(lambda: scan("no_such_table"), "table") is None
    assert load_or_none(lambda: scan("no_such_db.t"), "database") is None
    assert load_or_none(lambda: scan("days", ["no_such_column"]), "column") is None
    assert load_or_none(lambda: spark.read.parquet(str(tmp_path / "no")), "path") is None
    with pytest.raises(ZeroDivisionError):
        load_or_none(lambda: 1 / 0, "a bug is not an absent table")


def test_use_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS chosen")
    before = spark.catalog.currentDatabase()
    try:
        use_database("chosen")
        assert spark.catalog.currentDatabase() == "chosen"
        with pytest.raises(AnalysisException):
            use_database("not_there")
    finally:
        use_database(before)


def test_whole_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_bytes("één\nregel\n".encode())
    (tmp_path / "in" / "deep" / "b.txt").write_bytes(b"A\xffB")
    (tmp_path / "in" / "c.txt").write_bytes(b"")
    (tmp_path / "in" / "d.bin").write_bytes(b"x")
    rows = whole_files(str(tmp_path / "in"), pattern="*.txt").collect()
    assert {r["path"].rsplit("/", 1)[1]: r["text"] for r in rows} == {
        "a.txt": "één\nregel\n", "b.txt": "A�B", "c.txt": "",
    }
    (tmp_path / "latin").mkdir()
    (tmp_path / "latin" / "e.txt").write_bytes("één".encode("latin-1"))
    assert whole_files(str(tmp_path / "latin"), "ISO-8859-1").first()["text"] == "één"


def test_multi_scan_by_a_range(spark):
    points = spark.createDataFrame([(1, 5), (2, 15), (3, 25)], "p long, x int")
    ranges = spark.createDataFrame([(1, 0, 10), (2, 0, 100), (9, 20, 30)], "r long, low int, high int")
    names = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "id long, name string")

    def found(frame):
        return sorted((row.p, row.r) for row in frame.collect())

    within = ("x", "low", "high")
    assert found(multi_scan([points, ranges], within=within)) == [(1, 1), (1, 2), (2, 2), (3, 2), (3, 9)]
    assert found(multi_scan([points, ranges], "p = r", within)) == [(1, 1), (2, 2)]
    both = multi_scan([names, ranges, points], "id = r AND name <> 'b'", within)
    assert found(both) == [(1, 1), (3, 9)]
    with pytest.raises(ValueError, match="connects"):
        multi_scan([names, ranges, points], "name <> 'b'", within)
    with pytest.raises(ValueError, match="0 tables"):
        multi_scan([points, names], within=within)
    with pytest.raises(ValueError, match="two tables"):
        multi_scan([ranges, names], "id = r", ("low", "low", "high"))


def test_equalities_beside_a_range_are_join_keys(spark):
    points = spark.range(1000).selectExpr("id AS p", "id % 50 AS x", "id % 7 AS k")
    ranges = spark.range(30).selectExpr("id AS r", "id AS low", "id + 5 AS high", "id % 7 AS j")
    plan = multi_scan([points, ranges], "k = j", ("x", "low", "high"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in text.splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    assert len(keys) == 1 and "_grid" in keys[0] and "k#" in keys[0] and "j#" in keys[0]
