"""Combining sources, joining the dimension, ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.operators import (
    Categories,
    Metric,
    add_ratios,
    attach_dimension,
    combine_sources,
    fill_zero,
    group_metrics,
    outer_combine,
    tag_date,
)
from dayfold.queries.tables import EVENT_TYPES, enterprise, events_of, read
from dayfold.sources import load_or_none

# The user whose key becomes null, to show how null keys are treated.
NULL_USER = 3


# Sources that between them cover all events, and when a key counts as hot.
DAILY_SOURCES = {"use_num": ("click", "view", "signup"), "end_num": ("purchase", "error")}
HOT_ROWS = 20


def _source(events, event_type):
    return events_of(events, event_type).select(F.col("user_id").alias("eid"), "props")


def _null_keyed(events, event_type):
    return events_of(events, event_type).select(
        F.nullif(F.col("user_id"), F.lit(NULL_USER)).alias("eid"), "props", "value"
    )


def _counts(events, *event_types, source=_source):
    return {
        f"{t}_num": group_metrics(source(events, t), counts={f"{t}_num": "*"})
        for t in event_types
    }


def combined(spark, sf_dir):
    return outer_combine(_counts(read(spark, sf_dir, "events"), *EVENT_TYPES), unique_keys=True)


def combined_unique(spark, sf_dir):
    counts = _counts(read(spark, sf_dir, "events"), *EVENT_TYPES, source=_null_keyed)
    return outer_combine(counts, unique_keys=True)


def combined_missing(spark, sf_dir):
    frames = _counts(read(spark, sf_dir, "events"), *EVENT_TYPES)
    frames["gift_num"] = load_or_none(lambda: read(spark, sf_dir, "no_such_source"), "gift_num")
    return outer_combine(frames, unique_keys=True)


def combined_null_key(spark, sf_dir):
    counts = _counts(read(spark, sf_dir, "events"), *EVENT_TYPES, source=_null_keyed)
    return outer_combine(counts, unique_keys=True)


def _daily(spark, sf_dir):
    """One row per user and day, so that users repeat, from all events in two sources."""
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    frames = {}
    for name, types in DAILY_SOURCES.items():
        rows = events.where(F.col("event_type").isin(*types))
        counts = group_metrics(rows, ["user_id", "day"], {name: "*"})
        frames[name] = counts.select(F.col("user_id").alias("eid"), name)
    return frames


def combined_repeated(spark, sf_dir):
    """Frames whose keys repeat: these are joined."""
    return outer_combine(_daily(spark, sf_dir))


def combined_split(spark, sf_dir):
    """As above, with keys that are null or missing in one source, and hot keys cut up."""
    frames = _daily(spark, sf_dir)
    key = F.nullif(F.col("eid"), F.lit(NULL_USER)).alias("eid")
    use = frames["use_num"].select(key, "use_num")
    end = frames["end_num"].where(F.col("eid") % 10 != 0).select(key, "end_num")
    return outer_combine({"use_num": use, "end_num": end, "gift_num": None}, hot_rows=HOT_ROWS)


def sources_counts(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return combine_sources({f"{t}_num": _null_keyed(events, t) for t in EVENT_TYPES})


def sources_mixed(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    seeds = events.select(
        F.nullif(F.col("user_id"), F.lit(NULL_USER)).alias("eid"), "event_type", "value"
    )
    sums = {"signup": "signup_sum", "error": "error_sum"}
    mixed = combine_sources(
        {
            "click_num": Metric(_null_keyed(events, "click")),
            "session_num": Metric(_null_keyed(events, "view"), "count_distinct", "props"),
            "spent": Metric(_null_keyed(events, "purchase"), "sum", "value"),
            "seeds": Categories(seeds, "event_type", sums, "value"),
            "gift_num": None,
        }
    )
    return mixed.select(
        "eid",
        "click_num",
        "session_num",
        "gift_num",
        *[F.round(c, 4).alias(c) for c in ("spent", "signup_sum", "error_sum")],
    )


def _attached(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumnRenamed("user_id", "eid")
    counts = group_metrics(events, counts={"click_num": "CASE event_type WHEN 'click' THEN 1 END"})
    return attach_dimension(counts, enterprise(spark, sf_dir))


def per_user_ratio(spark, sf_dir):
    ratios = [("click_num", "accountusedamount", "click_num_avg")]
    return fill_zero(add_ratios(_attached(spark, sf_dir), ratios))


def batch_date_tag(spark, sf_dir):
    return tag_date(_attached(spark, sf_dir), "20240110")


QUERIES = {
    "outer_combine": combined,
    "outer_combine_missing": combined_missing,
    "outer_combine_null_key": combined_null_key,
    "outer_combine_unique_keys": combined_unique,
    "outer_combine_repeated": combined_repeated,
    "outer_combine_split": combined_split,
    "combine_sources": sources_counts,
    "combine_sources_mixed": sources_mixed,
    "attach_dimension": _attached,
    "per_user_ratio": per_user_ratio,
    "batch_date_tag": batch_date_tag,
}


def _grouped_sql(name, event_type, aggregate, key="user_id"):
    return f"""{name} AS (SELECT {key} AS eid, {aggregate} AS {name} FROM events
          WHERE event_type = '{event_type}' GROUP BY 1)"""


NULL_KEY_SQL = f"nullif(user_id, {NULL_USER})"
COUNTS_SQL = (
    "SELECT coalesce(eid, 0) AS eid, "
    + ", ".join(f"coalesce({t}_num, 0) AS {t}_num" for t in EVENT_TYPES)
)
JOINED_SQL = f" FROM {EVENT_TYPES[0]}_num " + " ".join(
    f"FULL JOIN {t}_num USING (eid)" for t in EVENT_TYPES[1:]
)


def _with_counts(key):
    counts = [_grouped_sql(f"{t}_num", t, "count(*)", key) for t in EVENT_TYPES]
    return "WITH " + ", ".join(counts) + f" {COUNTS_SQL} {JOINED_SQL}"


DAILY_SQL = "WITH " + ", ".join(
    f"""{name.removesuffix("_num")}_days AS (
          SELECT user_id AS eid, count(*) AS {name} FROM events
          WHERE event_type IN {types} GROUP BY user_id, CAST(ts AS DATE))"""
    for name, types in DAILY_SOURCES.items()
)
ATTACHED_SQL = """
        SELECT eid, click_num, c_name AS enterpriseaccount, c_nationkey AS accountusedamount%s
        FROM (SELECT user_id AS eid, count(*) FILTER (WHERE event_type = 'click') AS click_num
              FROM events GROUP BY user_id)
        JOIN customer ON c_custkey = eid"""

ORACLES = {
    "outer_combine": _with_counts("user_id"),
    "outer_combine_missing": "WITH "
    + ", ".join(_grouped_sql(f"{t}_num", t, "count(*)") for t in EVENT_TYPES)
    + f" {COUNTS_SQL}, CAST(0 AS BIGINT) AS gift_num {JOINED_SQL}",
    "outer_combine_repeated": DAILY_SQL
    + """
        SELECT coalesce(eid, 0) AS eid, coalesce(use_num, 0) AS use_num,
          coalesce(end_num, 0) AS end_num
        FROM use_days FULL JOIN end_days USING (eid)""",
    "outer_combine_split": DAILY_SQL
    + f"""
        SELECT coalesce(eid, 0) AS eid, coalesce(use_num, 0) AS use_num,
          coalesce(end_num, 0) AS end_num, CAST(0 AS BIGINT) AS gift_num
        FROM (SELECT nullif(eid, {NULL_USER}) AS eid, use_num FROM use_days)
        FULL JOIN (SELECT nullif(eid, {NULL_USER}) AS eid, end_num FROM end_days
                   WHERE eid % 10 <> 0) USING (eid)""",
    "outer_combine_null_key": _with_counts(NULL_KEY_SQL),
    "outer_combine_unique_keys": _with_counts(NULL_KEY_SQL),
    "combine_sources": _with_counts(NULL_KEY_SQL),
    "combine_sources_mixed": "WITH "
    + ", ".join(
        [
            _grouped_sql("click_num", "click", "count(*)", NULL_KEY_SQL),
            _grouped_sql("session_num", "view", "count(DISTINCT props)", NULL_KEY_SQL),
            _grouped_sql("spent", "purchase", "sum(value)", NULL_KEY_SQL),
            _grouped_sql("signup_sum", "signup", "sum(value)", NULL_KEY_SQL),
            _grouped_sql("error_sum", "error", "sum(value)", NULL_KEY_SQL),
        ]
    )
    + """
        SELECT coalesce(eid, 0) AS eid, coalesce(click_num, 0) AS click_num,
          coalesce(session_num, 0) AS session_num, CAST(0 AS BIGINT) AS gift_num,
          round(coalesce(spent, 0), 4) AS spent, round(coalesce(signup_sum, 0), 4) AS signup_sum,
          round(coalesce(error_sum, 0), 4) AS error_sum
        FROM click_num FULL JOIN session_num USING (eid) FULL JOIN spent USING (eid)
          FULL JOIN signup_sum USING (eid) FULL JOIN error_sum USING (eid)""",
    "attach_dimension": ATTACHED_SQL % "",
    "per_user_ratio": ATTACHED_SQL
    % ", coalesce(click_num / nullif(c_nationkey, 0), 0) AS click_num_avg",
    "batch_date_tag": ATTACHED_SQL % ", '20240110' AS actiondate",
}
