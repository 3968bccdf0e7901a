"""Run a daily job: ``python -m dayfold feed|message [yyyyMMdd] [--target TABLE]``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from dayfold.functions.dates import resolve_batch_date
from dayfold.plans import run_feed_job, run_message_job
from dayfold.plans.feed import FEATURE_TABLE
from dayfold.plans.message import MIX_TABLE


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="dayfold")
    parser.add_argument("job", choices=("feed", "message"))
    parser.add_argument("day", nargs="*", help="the day as yyyyMMdd; yesterday if left out")
    parser.add_argument("--target", help="table to write")
    options = parser.parse_args(arguments)
    day = resolve_batch_date(options.day)
    SparkSession.builder.appName(f"dayfold {options.job}").enableHiveSupport().getOrCreate()
    if options.job == "feed":
        run_feed_job(day, target=options.target or FEATURE_TABLE)
    else:
        run_message_job(day, options.target or MIX_TABLE)


if __name__ == "__main__":
    main()
