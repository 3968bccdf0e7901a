"""The composite jobs, for a day and for all days at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.operators import Categories
from dayfold.plans import FEED_TABLES, daily_feature_table, message_mix_table
from dayfold.queries.tables import EVENT_TYPES, enterprise, read
from dayfold.sources import day_range_scan

DAY = "20240110"
# Which type of event stands for which feed source, and for which kind of message.
FEED_METRICS = dict(zip(EVENT_TYPES, FEED_TABLES, strict=True))
MESSAGE_METRICS = {event_type: f"seed_{event_type}_num" for event_type in EVENT_TYPES}

EID = "user_id AS eid"
EVENT_DAY = "CAST(ts AS date) AS day"
SESSION = "props AS sessionID"


def _feed(events, *columns):
    """The five feed sources; they share the table of events, so it is read once."""
    rows = events.selectExpr(EID, "event_type", *columns)
    return {"events": Categories(rows, "event_type", FEED_METRICS)}


def feed_day(spark, sf_dir):
    events = day_range_scan(read(spark, sf_dir, "events"), DAY, "ts")
    return daily_feature_table(_feed(events), enterprise(spark, sf_dir), DAY)


def feed_all_days(spark, sf_dir):
    sources = _feed(read(spark, sf_dir, "events"), EVENT_DAY)
    return daily_feature_table(sources, enterprise(spark, sf_dir), day_column="day")


def _message_mix(spark, sf_dir, day_column=None):
    days = [EVENT_DAY] if day_column else []
    events = read(spark, sf_dir, "events")
    mix = message_mix_table(
        F.col("event_type") == "signup",
        events.selectExpr(EID, SESSION, "event_type", *days),
        events.selectExpr(EID, "event_type AS messagetype", "value AS count", *days),
        MESSAGE_METRICS,
        day_column,
    )
    sums = list(MESSAGE_METRICS.values())
    others = [c for c in mix.columns if c not in sums]
    return mix.select(*others, *[F.round(c, 4).alias(c) for c in sums])


def message_mix(spark, sf_dir):
    return _message_mix(spark, sf_dir)


def message_mix_all_days(spark, sf_dir):
    return _message_mix(spark, sf_dir, "day")


QUERIES = {
    "daily_feature_table": feed_day,
    "daily_feature_table_all_days": feed_all_days,
    "message_mix_table": message_mix,
    "message_mix_table_all_days": message_mix_all_days,
}


def _feed_sql(day_sql, where=""):
    counts = ", ".join(
        f"count(*) FILTER (WHERE event_type = '{t}') AS {metric}"
        for t, metric in FEED_METRICS.items()
    )
    averages = ", ".join(
        f"{metric}, coalesce({metric} / nullif(c_nationkey, 0), 0) AS {metric}_avg"
        for metric in FEED_TABLES
    )
    return f"""
        SELECT eid, c_name AS ea, actiondate, c_nationkey AS accountusedamount, {averages}
        FROM (SELECT user_id AS eid, {day_sql} AS actiondate, {counts}
              FROM events {where} GROUP BY 1, 2)
        JOIN customer ON c_custkey = eid"""


def _message_sql(keys):
    sums = ", ".join(
        f"round(coalesce(sum(value) FILTER (WHERE event_type = '{t}'), 0), 4) AS {metric}"
        for t, metric in MESSAGE_METRICS.items()
    )
    return f"""
        SELECT {keys},
          count(DISTINCT CASE WHEN event_type = 'signup' THEN props END) AS qx_newsession_num,
          count(DISTINCT props) AS qx_activesession_num, {sums}
        FROM events GROUP BY ALL"""


ORACLES = {
    "daily_feature_table": _feed_sql(
        f"'{DAY}'", "WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'"
    ),
    "daily_feature_table_all_days": _feed_sql("strftime(ts, '%Y%m%d')"),
    "message_mix_table": _message_sql("user_id AS eid"),
    "message_mix_table_all_days": _message_sql("user_id AS eid, CAST(ts AS DATE) AS day"),
}
