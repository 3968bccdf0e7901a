"""Scans, filters and row-local steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.functions import null_or_empty
from dayfold.operators import (
    drop_incomplete,
    fill_zero,
    preview_rows,
    rename_column,
    theta_join,
)
from dayfold.operators.aggregate import cross_join_count
from dayfold.queries.tables import read
from dayfold.sources import day_range_scan, multi_scan, query_view, scan


def scan_select(spark, sf_dir):
    return scan(read(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_nationkey"])


def scan_all(spark, sf_dir):
    return scan(read(spark, sf_dir, "supplier"))


def rename(spark, sf_dir):
    customers = scan(read(spark, sf_dir, "customer"), ["c_custkey", "c_name"])
    return rename_column(customers, "c_name", "ea")


def day_scan(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return day_range_scan(events, "20240110", "ts").select("event_id", "user_id", "event_type")


def filter_predicate(spark, sf_dir):
    return scan(
        read(spark, sf_dir, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice"],
        "o_totalprice > 100000 AND o_orderstatus = 'F'",
    )


def filter_category(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return scan(events, ["event_id", "user_id", "value"], F.col("event_type") == "click")


def null_or_empty_text(spark, sf_dir):
    texts = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(
        F.col("text"),
        F.regexp_replace("text", "[^ ]", ""),
        F.nullif(F.col("text"), F.col("text")),
        F.lit(""),
    )).alias("text"))
    return texts.select("doc_id", null_or_empty(F.col("text")).alias("is_blank"))


def multi_scan_equi(spark, sf_dir):
    tables = [read(spark, sf_dir, name) for name in ("supplier", "nation", "region")]
    joined = multi_scan(tables, "s_nationkey = n_nationkey AND n_regionkey = r_regionkey")
    return joined.select("s_suppkey", "n_name", "r_name")


def count_pairs(spark, sf_dir):
    names = ("customer", "nation", "region")
    return cross_join_count([read(spark, sf_dir, name) for name in names])


def theta(spark, sf_dir):
    low = F.col("n_nationkey") * F.lit(20000.0)
    bands = read(spark, sf_dir, "nation").select(
        "n_name", low.alias("low"), (low + 25000.0).alias("high")
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return theta_join(orders, bands, "o_totalprice", "low", "high").select(
        "o_orderkey", "n_name"
    )


def _opened_by(events, event_type, **length):
    """A range of time from each event of a type on."""
    ends = F.col("ts") + F.make_dt_interval(**{k: F.lit(v) for k, v in length.items()})
    return events.where(F.col("event_type") == event_type).select(
        F.col("event_id").alias("opener"),
        F.col("user_id").alias("opener_id"),
        F.col("ts").alias("opened"),
        ends.alias("closed"),
    )


def theta_time(spark, sf_dir):
    """Events in the ten minutes after a purchase, by timestamps without zone."""
    events = read(spark, sf_dir, "events")
    windows = _opened_by(events, "purchase", mins=10)
    clicks = events.select("event_id", "ts")
    return theta_join(clicks, windows, "ts", "opened", "closed").select("event_id", "opener")


def theta_date(spark, sf_dir):
    """Orders in a season per nation, by dates."""
    first = F.date_add(F.lit("1994-06-01").cast("date"), F.col("n_nationkey") * 60)
    seasons = read(spark, sf_dir, "nation").select(
        "n_name", first.alias("first"), F.date_add(first, 90).alias("after")
    )
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    return theta_join(orders, seasons, "day", "first", "after").select("o_orderkey", "n_name")


def multi_scan_band(spark, sf_dir):
    """What users do within two days of an error of theirs, and who they are: a range, equalities."""
    events = read(spark, sf_dir, "events")
    windows = _opened_by(events, "error", days=2)
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    acts = events.select("event_id", "user_id", "event_type", "ts")
    joined = multi_scan(
        [acts, windows, customers],
        "user_id = opener_id AND c_custkey = user_id AND event_type <> 'error'",
        within=("ts", "opened", "closed"),
    )
    return joined.select("event_id", "opener", "c_name")


def temp_view_sql(spark, sf_dir):
    messages = read(spark, sf_dir, "events").select("user_id", "event_type", "value")
    return query_view(
        messages,
        "seed_messages",
        "SELECT user_id AS eid, round(sum(value), 4) AS seed_click_num FROM seed_messages "
        "WHERE event_type = 'click' GROUP BY user_id",
    )


def _holey_orders(spark, sf_dir):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_custkey") % 7, F.lit(0)).alias("weekday"),
        F.when(urgent, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )


def zero_filled(spark, sf_dir):
    return fill_zero(_holey_orders(spark, sf_dir))


def complete_rows(spark, sf_dir):
    return drop_incomplete(_holey_orders(spark, sf_dir))


def preview(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return preview_rows(orders, order_by=["o_orderkey"])


QUERIES = {
    "scan_select": scan_select,
    "scan_all": scan_all,
    "rename_column": rename,
    "day_scan": day_scan,
    "filter_predicate": filter_predicate,
    "filter_category": filter_category,
    "null_or_empty": null_or_empty_text,
    "multi_scan_equi": multi_scan_equi,
    "cross_join_count": count_pairs,
    "theta_join": theta,
    "theta_join_time": theta_time,
    "theta_join_date": theta_date,
    "multi_scan_band": multi_scan_band,
    "temp_view_sql": temp_view_sql,
    "fill_zero": zero_filled,
    "drop_incomplete": complete_rows,
    "preview_rows": preview,
}

ORACLES = {
    "scan_select": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "scan_all": "SELECT * FROM supplier",
    "rename_column": "SELECT c_custkey, c_name AS ea FROM customer",
    "day_scan": """
        SELECT event_id, user_id, event_type FROM events
        WHERE strftime(ts, '%Y%m%d') = '20240110'""",
    "filter_predicate": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_totalprice > 100000 AND o_orderstatus = 'F'""",
    "filter_category": "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'",
    "null_or_empty": """
        SELECT doc_id, coalesce(value, '') = '' AS is_blank FROM (
          SELECT doc_id, unnest([text, regexp_replace(text, '[^ ]', '', 'g'), NULL, '']) AS value
          FROM documents)""",
    "multi_scan_equi": """
        SELECT s_suppkey, n_name, r_name FROM supplier, nation, region
        WHERE s_nationkey = n_nationkey AND n_regionkey = r_regionkey""",
    "cross_join_count": """
        SELECT CAST((SELECT count(*) FROM customer) * (SELECT count(*) FROM nation)
             * (SELECT count(*) FROM region) AS DECIMAL(38, 0)) AS pairs""",
    "theta_join": """
        SELECT o_orderkey, n_name FROM orders, nation
        WHERE o_totalprice >= n_nationkey * 20000.0
          AND o_totalprice < n_nationkey * 20000.0 + 25000.0""",
    "theta_join_time": """
        SELECT e.event_id, p.event_id AS opener FROM events e, events p
        WHERE p.event_type = 'purchase' AND e.ts >= p.ts AND e.ts < p.ts + INTERVAL 10 MINUTE""",
    "theta_join_date": """
        SELECT o_orderkey, n_name FROM orders, nation
        WHERE CAST(o_orderdate AS DATE) >= DATE '1994-06-01' + 60 * n_nationkey
          AND CAST(o_orderdate AS DATE) < DATE '1994-06-01' + 60 * n_nationkey + 90""",
    "multi_scan_band": """
        SELECT e.event_id, x.event_id AS opener, c_name FROM events e, events x, customer
        WHERE x.event_type = 'error' AND e.ts >= x.ts AND e.ts < x.ts + INTERVAL 2 DAY
          AND e.user_id = x.user_id AND c_custkey = e.user_id AND e.event_type <> 'error'""",
    "temp_view_sql": """
        SELECT user_id AS eid, round(sum(value), 4) AS seed_click_num FROM events
        WHERE event_type = 'click' GROUP BY user_id""",
    "fill_zero": """
        SELECT o_orderkey, o_custkey % 7 AS weekday,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE o_totalprice END AS price,
          nullif(o_orderstatus, 'P') AS status FROM orders""",
    "drop_incomplete": """
        SELECT o_orderkey, o_custkey % 7 AS weekday, o_totalprice AS price,
          o_orderstatus AS status FROM orders
        WHERE o_custkey % 7 <> 0 AND o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'""",
    "preview_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10""",
}
