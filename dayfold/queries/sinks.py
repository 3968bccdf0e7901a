"""Sinks: write to a fresh place in the shared folder, write again, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dayfold import sinks as S
from dayfold.functions.dates import compact_day
from dayfold.operators import group_metrics
from dayfold.queries.tables import read
from dayfold.sources import whole_files as read_files


def _fresh(spark, name):
    """A table name and a path that nothing else uses."""
    return f"{name}_{uuid.uuid4().hex}", S.shared_path(spark, name)


def _read_back(spark, table, path):
    """The data of a table that lies at ``path``; the catalog entry is not left behind."""
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(schema).parquet(path)


def append_table(spark, sf_dir):
    counts = group_metrics(read(spark, sf_dir, "orders"), ["o_custkey"], {"order_num": "*"})
    table, path = _fresh(spark, "append_table")
    S.append_table(counts, table, path)
    S.append_table(counts, table, path)
    return _read_back(spark, table, path)


def partitioned_write(spark, sf_dir):
    events = read(spark, sf_dir, "events").select(
        compact_day(F.col("ts")).alias("day"), "event_type"
    )
    counts = group_metrics(events, ["day", "event_type"], {"event_num": "*"})
    path = S.shared_path(spark, "partitioned_write")
    S.write_day(counts, path)
    rerun = counts.where(F.col("day") >= "20240116")
    S.write_day(rerun.withColumn("event_num", F.col("event_num") * 2), path)
    return spark.read.schema(counts.schema).parquet(path)


def day_table_rewrite(spark, sf_dir):
    """A day table that gets a column, half of its days again, and loses one of them."""
    days = read(spark, sf_dir, "events").withColumn("day", compact_day(F.col("ts")))
    counts = group_metrics(days, ["day", "event_type"], {"event_num": "*"})
    table, path = _fresh(spark, "day_table_rewrite")
    S.write_day_table(counts, table, path=path)
    later = counts.where(F.col("day") >= "20240116")
    S.write_day_table(later.withColumn("twice", F.col("event_num") * 2), table)
    S.write_day_table(counts.where(F.lit(False)), table, day="20240120", missing="null")
    return _read_back(spark, table, path).select("day", "event_type", "event_num", "twice")


def swapped_day(spark, sf_dir):
    """A day table of which one day is swapped twice and one is new; read through its catalog."""
    events = read(spark, sf_dir, "events").withColumn("day", compact_day(F.col("ts")))
    counts = group_metrics(events, ["day", "event_type"], {"event_num": "*"})
    table, path = _fresh(spark, "swapped_day")
    S.write_day_table(counts.where(F.col("day") < "20240116"), table, path=path)
    for factor in (5, 3):
        rows = counts.where(F.col("day") == "20240110")
        S.swap_day(rows.withColumn("event_num", F.col("event_num") * factor), table, "20240110")
    S.swap_day(counts.where(F.col("day") == "20240120").drop("day"), table, "20240120")
    rows = S.write_aside(spark.table(table), "swapped_day")
    spark.sql(f"DROP TABLE {table}")
    return rows.select("day", "event_type", "event_num")


def append_docs(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    path = S.shared_path(spark, "append_docs")
    S.append_docs(customers, path, fmt="parquet")
    S.append_docs(suppliers, fmt="parquet", config={"es.resource": path})
    return spark.read.schema(customers.schema).parquet(path)


def bulk_docs(spark, sf_dir):
    """Bulk lines: documents by id, some of them replaced, beside documents without id."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "text")
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("text")
    )
    path = S.shared_path(spark, "bulk_docs")
    S.append_docs(docs, path, "id", fmt="bulk")
    S.append_docs(customers, fmt="bulk", config={"es.resource": path, "es.mapping.id": "id"})
    S.append_docs(docs.select("lang", "text"), path, fmt="bulk")
    return S.read_bulk(spark, path, docs.schema)


def upsert_docs(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    active = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), "event_id", "event_type"
    )
    table, path = _fresh(spark, "upsert_docs")
    S.upsert_docs(customers, table, "id", path=path)
    S.upsert_docs(active, table, "id", order="event_id")
    return S.current_docs(_read_back(spark, table, path), "id")


def compact_docs(spark, sf_dir):
    """Orders by customer, in three batches that are merged twice."""
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", "o_orderstatus"
    )
    table, path = _fresh(spark, "compact_docs")
    for status in ("F", "O", "P"):
        batch = orders.where(F.col("o_orderstatus") == status)
        S.upsert_docs(batch, table, "id", order="o_orderkey", path=path)
        S.compact_docs(spark, table, "id")
    return _read_back(spark, table, path).select("id", "o_orderkey", "o_orderstatus")


def docs_as_of(spark, sf_dir):
    """Orders by customer as they were two batches ago, after the batches have been merged."""
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", "o_orderstatus"
    )
    table, path = _fresh(spark, "docs_as_of")
    for status in ("F", "O", "P"):
        batch = orders.where(F.col("o_orderstatus") == status)
        S.upsert_docs(batch, table, "id", order="o_orderkey", path=path)
    S.compact_docs(spark, table, "id", keep_old=True)
    rows = _read_back(spark, table, path)
    return S.current_docs(rows.where("upsert_batch <= 1"), "id")


def metrics_upsert(spark, sf_dir):
    customers = group_metrics(
        read(spark, sf_dir, "customer"), ["c_nationkey"], {"customers": "*"}
    ).withColumnRenamed("c_nationkey", "nation")
    suppliers = group_metrics(
        read(spark, sf_dir, "supplier"), ["s_nationkey"], {"suppliers": "*"}
    ).withColumnRenamed("s_nationkey", "nation")
    table, path = _fresh(spark, "metrics_upsert")
    S.metrics_upsert(customers, "nation", table, path=path)
    S.metrics_upsert(suppliers, "nation", table)
    return S.current_docs(_read_back(spark, table, path), "nation")


def _exported(spark, sf_dir):
    """Customers as lines of text in the shared folder."""
    rows = read(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")), "c_name"
    )
    path = S.shared_path(spark, "write_text")
    S.write_text(rows, path, separator="|", null_text="-")
    return path


def write_text(spark, sf_dir):
    return spark.read.text(_exported(spark, sf_dir)).select(F.col("value").alias("line"))


def text_round_trip(spark, sf_dir):
    """Whole texts, with their line breaks, written as lines and read back."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.nullif("lang", F.lit("en")).alias("lang"), "text", "n_chars"
    )
    path = S.shared_path(spark, "text_round_trip")
    S.write_text(docs, path, separator="|", escaped=True)
    return S.read_text(spark, path, docs.schema, separator="|")


def whole_files(spark, sf_dir):
    files = read_files(_exported(spark, sf_dir), pattern="*.txt")
    lines = F.split(F.regexp_replace("text", "\\n$", ""), "\n")
    return files.select(F.explode(lines).alias("line"))


QUERIES = {
    "append_table": append_table,
    "partitioned_write": partitioned_write,
    "day_table_rewrite": day_table_rewrite,
    "swap_day": swapped_day,
    "append_docs": append_docs,
    "bulk_docs": bulk_docs,
    "upsert_docs": upsert_docs,
    "compact_docs": compact_docs,
    "docs_as_of": docs_as_of,
    "metrics_upsert": metrics_upsert,
    "write_text": write_text,
    "text_round_trip": text_round_trip,
    "whole_files": whole_files,
}

LINES_SQL = """
        SELECT c_custkey || '|' || coalesce(nullif(c_mktsegment, 'MACHINERY'), '-') || '|' || c_name
          AS line FROM customer"""

ORACLES = {
    "append_table": """
        SELECT o_custkey, count(*) AS order_num FROM orders GROUP BY o_custkey
        UNION ALL SELECT o_custkey, count(*) AS order_num FROM orders GROUP BY o_custkey""",
    "partitioned_write": """
        SELECT day, event_type,
          CASE WHEN day >= '20240116' THEN 2 ELSE 1 END * count(*) AS event_num
        FROM (SELECT strftime(ts, '%Y%m%d') AS day, event_type FROM events)
        GROUP BY day, event_type""",
    "day_table_rewrite": """
        SELECT strftime(ts, '%Y%m%d') AS day, event_type, count(*) AS event_num,
          CASE WHEN strftime(ts, '%Y%m%d') >= '20240116' THEN 2 * count(*) END AS twice
        FROM events WHERE strftime(ts, '%Y%m%d') <> '20240120' GROUP BY 1, 2""",
    "swap_day": """
        SELECT strftime(ts, '%Y%m%d') AS day, event_type,
          CASE WHEN strftime(ts, '%Y%m%d') = '20240110' THEN 3 ELSE 1 END * count(*) AS event_num
        FROM events
        WHERE strftime(ts, '%Y%m%d') < '20240116' OR strftime(ts, '%Y%m%d') = '20240120'
        GROUP BY 1, 2""",
    "docs_as_of": """
        SELECT o_custkey AS id, max(o_orderkey) AS o_orderkey, o_orderstatus FROM orders JOIN (
            SELECT o_custkey, max(o_orderstatus) AS o_orderstatus FROM orders
            WHERE o_orderstatus IN ('F', 'O') GROUP BY o_custkey
          ) USING (o_custkey, o_orderstatus)
        GROUP BY o_custkey, o_orderstatus""",
    "append_docs": """
        SELECT c_custkey AS id, c_name AS name FROM customer
        UNION ALL SELECT s_suppkey, s_name FROM supplier""",
    "bulk_docs": """
        SELECT doc_id AS id, lang, text FROM documents
        WHERE doc_id NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT c_custkey, NULL, c_name FROM customer
        UNION ALL SELECT NULL, lang, text FROM documents""",
    "upsert_docs": """
        SELECT c_custkey AS id, c_name AS name, NULL::BIGINT AS event_id,
          NULL::VARCHAR AS event_type FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM events)
        UNION ALL
        SELECT user_id, NULL, max(event_id), arg_max(event_type, event_id) FROM events
        GROUP BY user_id""",
    "compact_docs": """
        SELECT o_custkey AS id, max(o_orderkey) AS o_orderkey,
          o_orderstatus FROM orders JOIN (
            SELECT o_custkey, max(o_orderstatus) AS o_orderstatus FROM orders
            WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_custkey
          ) USING (o_custkey, o_orderstatus)
        GROUP BY o_custkey, o_orderstatus""",
    "metrics_upsert": """
        SELECT c_nationkey AS nation, count(*) AS customers, NULL::BIGINT AS suppliers
        FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)
        GROUP BY c_nationkey
        UNION ALL
        SELECT s_nationkey, NULL, count(*) FROM supplier GROUP BY s_nationkey""",
    "write_text": LINES_SQL,
    "text_round_trip": "SELECT doc_id, nullif(lang, 'en') AS lang, text, n_chars FROM documents",
    "whole_files": LINES_SQL,
}
