"""Grouped aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.operators import (
    category_sums,
    count_bitmaps,
    find_duplicates,
    group_collect,
    group_metrics,
    number_terms,
    rolling_distinct,
    term_bitmaps,
)
from dayfold.queries.tables import EVENT_TYPES, read

# Parts small enough that the lists of the given conversations need several.
SMALL_PART = 3
WINDOW_DAYS = 7


def group_count(spark, sf_dir):
    return group_metrics(read(spark, sf_dir, "orders"), ["o_custkey"], {"order_num": "*"})


def group_count_col(spark, sf_dir):
    return group_metrics(
        read(spark, sf_dir, "orders"), ["o_custkey"], {"closed_num": "nullif(o_orderstatus, 'O')"}
    )


def group_count_distinct(spark, sf_dir):
    return group_metrics(
        read(spark, sf_dir, "events"), ["user_id"], {"session_num": "distinct props"}
    )


def group_sum(spark, sf_dir):
    sums = group_metrics(
        read(spark, sf_dir, "events"),
        ["user_id"],
        counts=(),
        sums={"total": "value", "big_total": F.when(F.col("value") > 200, F.col("value"))},
    )
    return sums.select("user_id", *[F.round(c, 4).alias(c) for c in ("total", "big_total")])


def group_multi_agg(spark, sf_dir):
    return group_metrics(
        read(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        counts={"line_num": "*", "order_num": "distinct l_orderkey"},
        sums={"sum_qty": "cast(l_quantity AS bigint)", "sum_number": "l_linenumber"},
    )


def sums_by_category(spark, sf_dir):
    names = {event_type: f"seed_{event_type}_num" for event_type in EVENT_TYPES}
    sums = category_sums(read(spark, sf_dir, "events"), "user_id", "event_type", "value", names)
    return sums.select("user_id", *[F.round(c, 4).alias(c) for c in names.values()])


def _turns(spark, sf_dir, part_rows):
    lists = group_collect(
        read(spark, sf_dir, "conversations"), "conv_id", "text", "turn", part_rows=part_rows
    )
    return lists.select(
        "conv_id",
        "part",
        F.size("values").cast("long").alias("n_values"),
        F.array_join("values", "|").alias("texts"),
    )


def collected(spark, sf_dir):
    return _turns(spark, sf_dir, 10_000)


def collected_in_parts(spark, sf_dir):
    return _turns(spark, sf_dir, SMALL_PART)


def duplicates(spark, sf_dir):
    return find_duplicates(read(spark, sf_dir, "documents"), "text")


def _session_bitmaps(spark, sf_dir):
    """The sessions of each user and day, as far as events of them have a value above 1."""
    session = F.when(F.col("value") > 1, F.col("props")).alias("session")
    events = read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), session)
    # Later days come with terms of their own, which are numbered after the known ones.
    first = number_terms(events.where(F.dayofmonth("day") <= 10), "session", "user_id")
    numbers = number_terms(events, "session", "user_id", first)
    return term_bitmaps(events, ["user_id", "day"], "session", numbers)


def distinct_merged(spark, sf_dir):
    return count_bitmaps(_session_bitmaps(spark, sf_dir), "user_id", "session_num")


def distinct_rolling(spark, sf_dir):
    bitmaps = _session_bitmaps(spark, sf_dir)
    return rolling_distinct(bitmaps, "user_id", "day", WINDOW_DAYS, "session_num")


QUERIES = {
    "group_count": group_count,
    "group_count_col": group_count_col,
    "group_count_distinct": group_count_distinct,
    "group_sum": group_sum,
    "group_multi_agg": group_multi_agg,
    "category_sums": sums_by_category,
    "group_collect": collected,
    "group_collect_parts": collected_in_parts,
    "find_duplicates": duplicates,
    "distinct_merged": distinct_merged,
    "distinct_rolling": distinct_rolling,
}


def _collect_sql(part_rows):
    return f"""
        SELECT conv_id, part, count(*) AS n_values,
          string_agg(text, '|' ORDER BY turn DESC) AS texts
        FROM (SELECT conv_id, turn, text,
                (row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) - 1)
                  // {part_rows} AS part
              FROM conversations)
        GROUP BY conv_id, part"""


ORACLES = {
    "group_count": "SELECT o_custkey, count(*) AS order_num FROM orders GROUP BY o_custkey",
    "group_count_col": """
        SELECT o_custkey, count(nullif(o_orderstatus, 'O')) AS closed_num
        FROM orders GROUP BY o_custkey""",
    "group_count_distinct": """
        SELECT user_id, count(DISTINCT props) AS session_num FROM events GROUP BY user_id""",
    "group_sum": """
        SELECT user_id, round(sum(value), 4) AS total,
          round(sum(value) FILTER (WHERE value > 200), 4) AS big_total
        FROM events GROUP BY user_id""",
    "group_multi_agg": """
        SELECT l_returnflag, l_linestatus, count(*) AS line_num,
          count(DISTINCT l_orderkey) AS order_num,
          CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty,
          CAST(sum(l_linenumber) AS BIGINT) AS sum_number
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "category_sums": "SELECT user_id, "
    + ", ".join(
        f"round(coalesce(sum(value) FILTER (WHERE event_type = '{t}'), 0), 4) AS seed_{t}_num"
        for t in EVENT_TYPES
    )
    + " FROM events GROUP BY user_id",
    "group_collect": _collect_sql(10_000),
    "group_collect_parts": _collect_sql(SMALL_PART),
    "distinct_merged": """
        SELECT user_id, count(DISTINCT CASE WHEN value > 1 THEN props END) AS session_num
        FROM events GROUP BY user_id""",
    "distinct_rolling": f"""
        SELECT d.user_id, d.day,
          count(DISTINCT CASE WHEN e.value > 1 THEN e.props END) AS session_num
        FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events) d
        JOIN events e ON e.user_id = d.user_id
          AND CAST(e.ts AS DATE) BETWEEN d.day - {WINDOW_DAYS - 1} AND d.day
        GROUP BY d.user_id, d.day""",
    "find_duplicates": "SELECT text FROM documents GROUP BY text HAVING count(*) > 1",
}
