"""Message features: distinct sessions and message volume per type, one row per entity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.operators.clean import tag_date
from dayfold.operators.combine import Categories, DistinctCounts, Metric, combine_sources
from dayfold.sinks.tables import write_day_table
from dayfold.sources.scans import day_scan, load_or_none

# Message types and the metric each is summed into.
MESSAGE_CATEGORIES = {
    "T": "qx_seedt_num",
    "A": "qx_seeda_num",
    "I": "qx_seedi_num",
    "L": "qx_seedl_num",
    "D": "qx_seedd_num",
    "AVEvent": "qx_seedavevent_num",
    "MeetingCard": "qx_seedmeetingcard_num",
    "IGT@4": "qx_seedigt4_num",
    "IGT@5": "qx_seedigt5_num",
    "LWN": "qx_seedlwn_num",
    "LWV@1": "qx_seedlwv1_num",
}
# Source tables and columns, and the two session metrics.
NEW_SESSIONS_TABLE = "core_business.new_session"
ACTIVE_SESSIONS_TABLE = "core_business.active_session"
MESSAGE_TABLE = "message"
KEY = "eid"
SESSION = "sessionID"
CATEGORY = "messagetype"
COUNT = "count"
NEW_SESSIONS = "qx_newsession_num"
ACTIVE_SESSIONS = "qx_activesession_num"

MIX_TABLE = "ml_raw.message_mix"


def message_mix_table(
    new_sessions: DataFrame | Column | None,
    active_sessions: DataFrame | None,
    messages: DataFrame | None,
    categories: Mapping[str, str] = MESSAGE_CATEGORIES,
    day_column: str | None = None,
) -> DataFrame:
    """Distinct new and active sessions and the message volume per type, per entity.

    The inputs are raw rows, restricted to a day beforehand or, with ``day_column``, grouped by
    it as well. Entities that occur in any input appear; what they lack is 0. Where one table
    holds both kinds of session, ``new_sessions`` is a condition on the rows of
    ``active_sessions``; each distinct session is then shuffled once.
    """
    keys = [KEY] if day_column is None else [KEY, day_column]
    if isinstance(new_sessions, Column):
        subsets = {NEW_SESSIONS: new_sessions, ACTIVE_SESSIONS: F.lit(True)}
        sessions = {"sessions": DistinctCounts(active_sessions, SESSION, subsets)}
    else:
        sessions = {
            NEW_SESSIONS: Metric(new_sessions, "count_distinct", SESSION),
            ACTIVE_SESSIONS: Metric(active_sessions, "count_distinct", SESSION),
        }
    volume = {MESSAGE_TABLE: Categories(messages, CATEGORY, categories, COUNT)}
    return combine_sources(sessions | volume, keys)


def run_message_job(
    dt: str,
    target: str = MIX_TABLE,
    new_sessions: str = NEW_SESSIONS_TABLE,
    active_sessions: str = ACTIVE_SESSIONS_TABLE,
    messages: str = MESSAGE_TABLE,
    path: str | None = None,
) -> None:
    """Compute the message features of one day and write them, replacing that day.

    Missing session tables give zeros; the message table is required.
    """

    def sessions(table: str) -> DataFrame | None:
        return load_or_none(lambda: day_scan(table, dt).select(KEY, SESSION), table)

    rows = day_scan(messages, dt).select(KEY, COUNT, CATEGORY)
    mix = message_mix_table(sessions(new_sessions), sessions(active_sessions), rows)
    write_day_table(tag_date(mix, dt), target, "actiondate", path, day=dt, missing="null")
