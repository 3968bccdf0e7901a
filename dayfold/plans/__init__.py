"""The composite daily jobs."""

from dayfold.plans.feed import FEED_TABLES, daily_feature_table, run_feed_job
from dayfold.plans.message import (
    MESSAGE_CATEGORIES,
    message_mix_table,
    run_message_job,
)

__all__ = [
    "FEED_TABLES",
    "MESSAGE_CATEGORIES",
    "daily_feature_table",
    "message_mix_table",
    "run_feed_job",
    "run_message_job",
]
