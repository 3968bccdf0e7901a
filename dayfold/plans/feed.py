"""Feed features: counts per source, per-user averages, one row per entity and day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions.dates import compact_day
from dayfold.operators.clean import (
    add_ratios,
    drop_incomplete,
    fill_zero,
    rename_column,
    select_ordered,
    tag_date,
)
from dayfold.operators.combine import Source, combine_sources, metric_names
from dayfold.operators.join import attach_dimension
from dayfold.sinks.tables import append_table, write_day_table
from dayfold.sources.scans import day_scan, load_or_none, scan

# Metric names and the tables they count.
FEED_TABLES = {
    "xt_feedback_num": "core_business.feed_action_feed_reply",
    "xt_like_num": "core_business.feed_action_feed_like",
    "xt_at_num": "core_business.feed_at",
    "xt_reward_num": "core_business.feed_action_reward",
    "xt_redpacket_num": "core_business.luck_money",
}
# The dimension, its columns, and the table written.
ENTERPRISE_TABLE = "ml_test.enterprise"
KEY = "eid"
ACCOUNT = "enterpriseaccount"
USERS = "accountusedamount"
FEATURE_TABLE = "ml_raw.xt_feed_avg_fundamentals"


def daily_feature_table(
    sources: Mapping[str, Source],
    enterprise: DataFrame,
    dt: str | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """Counts per entity of every source, and each count per user of the entity.

    ``sources`` maps metric names to raw rows with the key column ``eid``, already restricted to
    day ``dt``; sources that share a table can come as one ``Categories``.

    To fill in many days at once give ``day_column`` instead: the sources then hold it too, and
    the result has one row per entity and day, as if the days had been run one by one and put
    together.
    """
    if (dt is None) == (day_column is None):
        raise ValueError("give either dt or day_column")
    keys = [KEY] if day_column is None else [KEY, day_column]
    counts = combine_sources(sources, keys)
    dimension = rename_column(enterprise.select(KEY, ACCOUNT, USERS), ACCOUNT, "ea")
    rows = drop_incomplete(attach_dimension(counts, dimension, KEY))
    rated = add_ratios(rows, [(m, USERS, f"{m}_avg") for m in metric_names(sources)])
    if day_column is None:
        tagged = tag_date(rated, dt)
    else:
        kind = rated.schema[day_column].dataType.typeName()
        day = F.col(day_column)
        tagged = rated.withColumn("actiondate", day if kind == "string" else compact_day(day))
        if day_column != "actiondate":
            tagged = tagged.drop(day_column)
    return select_ordered(fill_zero(tagged), [KEY, "ea", "actiondate", USERS])


def run_feed_job(
    dt: str,
    tables: Mapping[str, str] = FEED_TABLES,
    enterprise: str = ENTERPRISE_TABLE,
    target: str = FEATURE_TABLE,
    path: str | None = None,
    append: bool = False,
) -> None:
    """Compute the features of one day and write them, replacing that day in the target.

    A source table that cannot be loaded gives zeros. A missing dimension is an error.
    ``append`` adds the rows to the target instead, whatever it holds.
    """
    sources = {
        metric: load_or_none(lambda t=table: day_scan(t, dt).select(KEY), table)
        for metric, table in tables.items()
    }
    features = daily_feature_table(sources, scan(enterprise, [KEY, ACCOUNT, USERS]), dt)
    if append:
        append_table(features, target, path)
    else:
        write_day_table(features, target, "actiondate", path, day=dt, missing="null")
