"""Sinks: write, read back, write again."""

import json
import os
import random
import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dayfold.sinks import (
    append_docs,
    append_table,
    bulk,
    compact_docs,
    current_docs,
    documents,
    drop_batches,
    drop_old_days,
    latest_per_id,
    metrics_upsert,
    read_bulk,
    read_text,
    shared_path,
    swap_day,
    upsert_docs,
    write_bulk,
    write_day,
    write_day_table,
    write_text,
)


def fresh(name):
    return f"{name}_{uuid.uuid4().hex}"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def data_files(path):
    return [f for _, _, files in os.walk(path) for f in files if f.startswith("part-")]


def test_append_table(spark, tmp_path):
    table, path = fresh("appended"), str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n long, s string").repartition(2)
    append_table(frame, table, path)
    assert len(data_files(path)) == 1  # a small result is one file without a single-task write
    append_table(frame, table, path)
    assert rows_of(spark.table(table)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    managed = fresh("managed")
    append_table(frame, managed)
    assert spark.table(managed).count() == 2


def day_rows(spark, day, count):
    return spark.range(count).select(F.col("id"), F.lit(day).alias("day"))


def test_write_day_replaces_days(spark, tmp_path):
    path = str(tmp_path / "days")
    write_day(day_rows(spark, "20240110", 320), path)
    write_day(day_rows(spark, "20240111", 340), path)
    write_day(day_rows(spark, "20240110", 330), path)
    back = spark.read.schema("id long, day string").parquet(path)
    assert rows_of(back.groupBy("day").count()) == [("20240110", 330), ("20240111", 340)]
    assert sorted(d for d in os.listdir(path) if d.startswith("day=")) == [
        "day=20240110", "day=20240111",
    ]


def test_write_day_table(spark, tmp_path):
    table = fresh("days")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_day_table(day_rows(spark, "20240110", 3), table, path=str(tmp_path / "t"))
    write_day_table(day_rows(spark, "20240111", 4).select("day", "id"), table)
    write_day_table(day_rows(spark, "20240110", 5), table)
    assert rows_of(spark.table(table).groupBy("day").count()) == [("20240110", 5), ("20240111", 4)]
    assert dict(spark.table(table).dtypes)["day"] == "string"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_write_day_table_adds_columns(spark, tmp_path):
    table = fresh("days")
    write_day_table(day_rows(spark, "20240110", 1), table, path=str(tmp_path / "t"))
    more = day_rows(spark, "20240111", 1).withColumn("extra", F.lit(7))
    write_day_table(more, table)
    assert rows_of(spark.table(table).select("day", "extra")) == [
        ("20240110", None), ("20240111", 7),
    ]
    with pytest.raises(ValueError, match="extra"):
        write_day_table(day_rows(spark, "20240110", 1), table)
    write_day_table(day_rows(spark, "20240110", 2), table, missing="null")
    assert spark.table(table).count() == 3


@pytest.mark.parametrize("external", [True, False])
def test_write_day_table_empties_a_day(spark, tmp_path, external):
    table = fresh("days")
    path = str(tmp_path / "t") if external else None
    for day in ("20240110", "20240111"):
        write_day_table(day_rows(spark, day, 3), table, path=path, day=day)
    none = day_rows(spark, "20240110", 3).limit(0)
    write_day_table(none, table, day="20240110")
    write_day_table(none, table, day="20240112")
    assert rows_of(spark.table(table).groupBy("day").count()) == [("20240111", 3)]
    write_day_table(day_rows(spark, "20240110", 2), table, day="20240110")
    assert spark.table(table).count() == 5


def test_nothing_written_aside_stays(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(root))
    table = fresh("docs")
    docs = spark.createDataFrame([("1", "a")], "id string, v string")
    upsert_docs(docs, table, "id", path=str(tmp_path / "t"))
    upsert_docs(docs, table, "id")
    write_day_table(day_rows(spark, "20240110", 3), fresh("days"), day="20240110")
    assert set(os.listdir(root)) == before


def test_write_text(spark, tmp_path):
    path = str(tmp_path / "text")
    frame = spark.createDataFrame([(1, None, 2.5), (2, "b", None)], "n int, s string, d double")
    write_text(frame, path)
    write_text(frame.limit(1), path, separator="|", null_text="-")
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["1\t\t2.5", "1|-|2.5", "2\tb\t"]


def test_append_docs(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("1", "a")], "id string, v string")
    append_docs(docs, path, fmt="json")
    append_docs(docs, fmt="json", config={"es.resource": path})
    append_docs({"id": "1", "v": "a"}, path, config={"compression": "gzip"}, fmt="json")
    with pytest.raises(ValueError, match="upsert_docs"):
        append_docs(docs, path, id_field="id", fmt="json")
    assert rows_of(spark.read.schema(docs.schema).json(path)) == [("1", "a")] * 3
    with pytest.raises(ValueError, match="es.resource"):
        append_docs(docs)


def test_latest_per_id(spark):
    docs = spark.createDataFrame(
        [("1", "a", 1), ("1", "b", 3), ("1", "c", 2), ("2", "x", None), ("2", "y", None)],
        "id string, v string, at int",
    )
    assert rows_of(latest_per_id(docs, "id", "at")) == [("1", "b", 3), ("2", "y", None)]
    assert latest_per_id(docs, "id", "at").columns == docs.columns
    assert rows_of(latest_per_id(docs.select("v", "id"), "id")) == [("c", "1"), ("y", "2")]
    assert rows_of(latest_per_id(docs.select("id"), "id")) == [("1",), ("2",)]


def state(spark, table, id_field="id"):
    return current_docs(spark.table(table), id_field)


def test_upsert_docs(spark, tmp_path):
    table, path = fresh("docs"), str(tmp_path / "t")
    base = spark.createDataFrame([("1", "a", 1), ("2", "b", 1)], "id string, v string, n int")
    new = spark.createDataFrame([("2", "c"), ("3", "d")], "id string, v string")
    upsert_docs(base, table, "id", path=path)
    upsert_docs(new, table, "id")
    expected = [("1", "a", 1), ("2", "c", None), ("3", "d", None)]
    assert rows_of(state(spark, table).select("id", "v", "n")) == expected
    upsert_docs(new, table, "id")  # the same batch again changes nothing
    assert rows_of(state(spark, table).select("id", "v", "n")) == expected
    extra = spark.createDataFrame([("3", 2.5)], "id string, extra double")
    upsert_docs(extra, table, "id")
    assert rows_of(state(spark, table).select("id", "v", "n", "extra")) == [
        ("1", "a", 1, None), ("2", "c", None, None), ("3", None, None, 2.5),
    ]


def test_upsert_writes_only_its_batch(spark, tmp_path):
    table, path = fresh("docs"), str(tmp_path / "t")
    docs = spark.range(20_000).select(F.col("id"), F.lit("old").alias("v"))
    upsert_docs(docs, table, "id", path=path)

    def files():
        return {
            f"{d}/{f}"
            for d in os.listdir(path)
            if d.startswith("upsert_batch=")
            for f in os.listdir(f"{path}/{d}")
            if f.startswith("part-")
        }

    before = files()
    new = spark.range(1000).select(F.col("id").cast("int"), F.lit("new").alias("v"))
    upsert_docs(new, table, "id")
    assert before < files() and len(files() - before) == 1
    assert state(spark, table).count() == 20_000
    assert state(spark, table).where("v = 'new'").count() == 1000


@pytest.mark.parametrize("external", [True, False])
def test_compacting_keeps_the_state(spark, tmp_path, external):
    table = fresh("docs")
    path = str(tmp_path / "t") if external else None
    for batch in ([("1", "a"), ("2", "b")], [("2", "c")], [("3", "d"), ("1", "e")]):
        upsert_docs(spark.createDataFrame(batch, "id string, v string"), table, "id", path=path)
    expected = [("1", "e"), ("2", "c"), ("3", "d")]
    for _ in range(2):
        assert rows_of(state(spark, table)) == expected
        compact_docs(spark, table, "id")
        assert rows_of(spark.table(table).select("id", "v")) == expected
        if external:
            assert sum(d.startswith("upsert_batch=") for d in os.listdir(path)) == 1
    upsert_docs(spark.createDataFrame([("3", "z")], "id string, v string"), table, "id")
    assert rows_of(state(spark, table)) == [*expected[:2], ("3", "z")]


def test_upsert_of_maps(spark, tmp_path):
    table = fresh("docs")
    docs = spark.createDataFrame(
        [("1", {"a": 1}, 1), ("1", {"b": 2}, 2), ("2", None, 1)],
        "id string, m map<string, int>, at int",
    )
    upsert_docs(docs, table, "id", order="at", path=str(tmp_path / "t"))
    upsert_docs(docs.where("id = '2'").select("id", F.create_map(F.lit("c"), "at").alias("m")), table, "id")
    found = {r.id: (r.m, r["at"]) for r in state(spark, table).collect()}
    assert found == {"1": ({"b": 2}, 2), "2": ({"c": 1}, None)}
    assert latest_per_id(docs.drop("at"), "id").count() == 2


def test_upsert_batch_with_copies_and_orders(spark, tmp_path):
    table = fresh("docs")
    hot = spark.range(300).select(
        F.when(F.col("id") < 100, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    upsert_docs(hot, table, "k", order="at", path=str(tmp_path / "t"))
    assert spark.table(table).count() == 201
    assert spark.table(table).where("k = 1").select("at").collect() == [(99,)]


def test_upsert_needs_ids_and_its_own_tables(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a")], "id string, v string")
    with pytest.raises(Exception, match="a document has no id"):
        upsert_docs(docs, fresh("docs"), "id", path=str(tmp_path / "t"))
    table = fresh("foreign")
    append_table(docs, table, str(tmp_path / "f"))
    with pytest.raises(ValueError, match="was not written by upsert_docs"):
        upsert_docs(docs, table, "id")


def test_metrics_upsert(spark, tmp_path):
    table = fresh("metrics")
    metrics_upsert({"iteration": "70", "length": "2.5"}, "iteration", table, path=str(tmp_path / "t"))
    metrics_upsert({"iteration": "70", "size": "3.5"}, "iteration", table)
    metrics_upsert({"iteration": "71", "size": "4.5"}, "iteration", table)
    assert rows_of(state(spark, table, "iteration").select("iteration", "length", "size")) == [
        ("70", None, "3.5"), ("71", None, "4.5"),
    ]


def test_shared_path_reads_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first != second and first.startswith(root.rstrip("/") + "/x-")


def day_table(spark, tmp_path, external=True):
    table = fresh("days")
    rows = [("20240109", "a", 1), ("20240110", "b", 2), ("20240110", "c", 3)]
    frame = spark.createDataFrame(rows, "day string, k string, n long")
    write_day_table(frame, table, path=str(tmp_path / "t") if external else None)
    return table, frame


@pytest.mark.parametrize("external", [True, False])
def test_swap_day(spark, tmp_path, external):
    table, frame = day_table(spark, tmp_path, external)
    old = rows_of(spark.table(table).select("day", "k", "n"))
    files = spark.table(table).inputFiles()
    new = spark.createDataFrame([("x", 7), ("y", 8)], "k string, n int")
    swap_day(new, table, "20240110")
    swap_day(new, table, "20240110")
    swap_day(new.limit(1), table, "20240111")
    expected = [("20240109", "a", 1), ("20240110", "x", 7), ("20240110", "y", 8), ("20240111", "x", 7)]
    assert rows_of(spark.table(table).select("day", "k", "n")) == expected
    # Whoever had planned to read the old day still can.
    kept = spark.read.parquet(*files)
    assert sorted(r.n for r in kept.collect()) == [n for _, _, n in old]
    # An empty day, one more column, and a table that knows its days when it is read again.
    swap_day(new.limit(0), table, "20240109")
    swap_day(new.withColumn("more", F.lit("m")), table, "20240111")
    found = rows_of(spark.table(table).select("day", "k", "n", "more"))
    assert [r for r in found if r[0] != "20240111"] == [(*r, None) for r in expected[1:3]]
    assert [r for r in found if r[0] == "20240111"] == [("20240111", "x", 7, "m"), ("20240111", "y", 8, "m")]
    assert drop_old_days(spark, table, 3600) == []
    assert len(drop_old_days(spark, table, 0)) == 2
    assert rows_of(spark.table(table).select("day", "k", "n", "more")) == found


def test_a_swap_that_dies_changes_nothing(spark, tmp_path):
    table, frame = day_table(spark, tmp_path)
    old = rows_of(spark.table(table))
    broken = spark.range(100).select(
        F.lit("z").alias("k"),
        F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("died"))).alias("n"),
    )
    with pytest.raises(Exception, match="died"):
        swap_day(broken, table, "20240110")
    assert rows_of(spark.table(table)) == old
    versions = tmp_path / "t" / "_versions"
    assert not versions.exists() or not os.listdir(versions)
    with pytest.raises(Exception, match="rows of another day: 20240109"):
        swap_day(frame, table, "20240110")
    with pytest.raises(ValueError, match="lack: n"):
        swap_day(frame.select("k"), table, "20240110")
    with pytest.raises(ValueError, match="not partitioned"):
        swap_day(frame, table, "20240110", "k")
    assert rows_of(spark.table(table)) == old


def test_two_writers_get_different_batches(spark, tmp_path, monkeypatch):
    """A batch that comes in while another one is being written."""
    table = fresh("docs")
    schema = "id string, v string"
    upsert_docs(spark.createDataFrame([("1", "a")], schema), table, "id", path=str(tmp_path / "t"))
    plain, others = documents._write_batch, [[("1", "b"), ("2", "b")], [("3", "c")]]

    def meanwhile(docs, name):
        folder = plain(docs, name)
        if others:
            upsert_docs(spark.createDataFrame(others.pop(), schema), table, "id")
        return folder

    monkeypatch.setattr(documents, "_write_batch", meanwhile)
    upsert_docs(spark.createDataFrame([("2", "z")], schema), table, "id")
    batches = sorted(r[0] for r in spark.table(table).select("upsert_batch").distinct().collect())
    assert batches == [0, 1, 2, 3]
    assert rows_of(state(spark, table)) == [("1", "b"), ("2", "z"), ("3", "c")]
    # A batch that comes in while the others are merged is not lost.
    others.append([("1", "late")])
    assert compact_docs(spark, table, "id") == [0, 1, 2, 3, 4]
    assert rows_of(spark.table(table).select("id", "v")) == [("1", "late"), ("2", "z"), ("3", "c")]
    assert [d for d in os.listdir(tmp_path / "t") if d.startswith("_writing")] == []


def test_readers_outlive_a_compaction(spark, tmp_path):
    table = fresh("docs")
    schema = "id string, v string"
    for batch in ([("1", "a"), ("2", "b")], [("2", "c")]):
        upsert_docs(spark.createDataFrame(batch, schema), table, "id", path=str(tmp_path / "t"))
    files = spark.table(table).inputFiles()
    reader = spark.read.parquet(*files)
    old = compact_docs(spark, table, "id", keep_old=True)
    assert old == [0, 1] and sorted(r.v for r in reader.collect()) == ["a", "b", "c"]
    expected = [("1", "a"), ("2", "c")]
    assert rows_of(state(spark, table)) == expected
    before = current_docs(spark.table(table).where("upsert_batch <= 0"), "id")
    assert rows_of(before) == [("1", "a"), ("2", "b")]
    drop_batches(spark, table, old)
    assert rows_of(spark.table(table).select("id", "v")) == expected


@pytest.mark.parametrize("separator", ["\t", "|", "^", "]", "||", "é-"])
def test_escaped_text_comes_back(spark, tmp_path, separator):
    draw = random.Random(8)
    marks = ["\\", "n", "r", "s", "N", "\n", "\r", separator, "", "x", "é", "\u2028", "\x00"]
    rows = [
        (i, draw.choice([None, "".join(draw.choices(marks, k=draw.randint(0, 9)))]), "\\" * (i % 4))
        for i in range(300)
    ]
    rows += [(300, "\\N", "\\\\n"), (301, "", ""), (None, None, None)]
    frame = spark.createDataFrame(rows, "i long, a string, b string")
    path = str(tmp_path / "t")
    write_text(frame, path, separator, escaped=True)
    assert rows_of(read_text(spark, path, frame.schema, separator)) == rows_of(frame)
    with pytest.raises(Exception, match="a line with 3 values"):
        read_text(spark, path, frame.select("i", "a").schema, separator).collect()
    for wrong in ("", "n", "\\", "a\n"):
        with pytest.raises(ValueError, match="cannot separate"):
            write_text(frame, path, wrong, escaped=True)


def test_bulk_documents(spark, tmp_path):
    path = str(tmp_path / "bulk")
    kinds = "id long, `a b` string, at timestamp, x double, d decimal(9,2), raw binary, l array<int>"
    at = datetime(2024, 5, 6, 7, 8, 9, 123_456)
    tricky = 'line\n{ "index": {"_id":"1"} }\n{"id":9} \\ "quoted" \r\u2028 end'
    docs = spark.createDataFrame(
        [(1, tricky, at, 0.1, Decimal("1.50"), b"\xff\n", [1, None]), (2, "", None, None, None, None, []),
         (3, None, None, float("nan"), None, None, None)], kinds)
    append_docs(docs, path, "id", fmt="bulk")
    assert sorted(map(repr, read_bulk(spark, path, docs.schema).collect())) == sorted(
        map(repr, docs.collect())
    )
    again = spark.createDataFrame([(2, "new"), (4, "one"), (4, "two")], "id long, `a b` string")
    append_docs(again, path, "id", fmt="bulk")
    append_docs({"a b": "no id"}, path, fmt="bulk")
    append_docs({"a b": "no id"}, path, fmt="bulk")
    found = read_bulk(spark, path, docs.schema).select("id", "a b").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(1, tricky), (2, "new"), (3, None), (4, "two"), (None, "no id"), (None, "no id")], key=repr
    )
    lines = spark.read.text(f"{path}/bulk_batch=1").where("value <> ''").collect()
    assert len(lines) == 4 and all(isinstance(json.loads(r[0]), dict) for r in lines)
    append_docs(docs.limit(0), path, "id", fmt="bulk")
    assert read_bulk(spark, path, docs.schema).count() == 6


def test_bulk_write_that_dies_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "bulk")
    docs = spark.range(100).repartition(4)
    write_bulk(docs, path, "id")
    bad = docs.withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("dies"))).cast("int"))
    with pytest.raises(Exception, match="dies"):
        write_bulk(bad, path, "id")
    assert sorted(os.listdir(path)) == ["bulk_batch=0"]
    with pytest.raises(Exception, match="no id"):
        append_docs(spark.createDataFrame([(None,)], "id long"), path, "id", fmt="bulk")
    assert sorted(os.listdir(path)) == ["bulk_batch=0"]
    assert read_bulk(spark, path, docs.schema).count() == 100


def test_bulk_writers_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bulk")
    assert write_bulk(spark.range(3), path) == 0
    monkeypatch.setattr(bulk, "_numbers", lambda *_: [])  # as if the other had not been seen
    assert write_bulk(spark.range(4), path) == 1
    assert read_bulk(spark, path, spark.range(1).schema).count() == 7


def test_bulk_files_are_read_in_parts(spark, tmp_path):
    path = str(tmp_path / "bulk")
    docs = spark.range(3000).withColumn("t", F.repeat(F.lit("é\n{ "), F.col("id").cast("int") % 50))
    write_bulk(docs.coalesce(1), path, "id")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = read_bulk(spark, path, docs.schema)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
