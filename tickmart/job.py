"""The pipeline as spark-submit jobs.

    spark-submit tickmart/job.py --warehouse URI land-prices URI
    spark-submit tickmart/job.py --warehouse URI load              # stage what landed, load it
    spark-submit tickmart/job.py --warehouse URI load --full       # rebuild everything
    spark-submit tickmart/job.py --warehouse URI stream --every "5 minutes"
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tickmart.plans import control, load, staging  # noqa: E402
from tickmart.sources import prices, profiles  # noqa: E402
from tickmart.sources.tables import Warehouse, layout  # noqa: E402
from tickmart.streaming.stream import stream_load  # noqa: E402


def arguments(args: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="intraday market data pipeline")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--staging-unit", choices=("day", "month"), default="month")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("land-prices", "land-sectors", "land-profiles"):
        jobs.add_parser(name).add_argument("path")
    jobs.add_parser("reset-landing")
    for name in ("load", "stream"):
        job = jobs.add_parser(name)
        job.add_argument("--minutes", type=int, default=15, help="bar width")
    jobs.choices["load"].add_argument("--full", action="store_true", help="rebuild from all staged ticks")
    jobs.choices["load"].add_argument("--only-clean", action="store_true", help="leave flagged ticks out of bars")
    jobs.choices["load"].add_argument("--clear-bars", action="store_true", help="empty the bar table afterwards")
    jobs.choices["stream"].add_argument("--every", help="trigger interval; without it, until landing is used up")
    return parser.parse_args(args)


def run(spark: SparkSession, args: list[str] | None = None) -> None:
    a = arguments(args)
    wh = Warehouse(spark, a.warehouse, a.staging_unit)
    if a.job == "land-prices":
        prices.land_prices(wh, a.path)
    elif a.job == "land-sectors":
        profiles.land_sectors(wh, a.path)
    elif a.job == "land-profiles":
        profiles.land_profiles(wh, a.path)
    elif a.job == "reset-landing":
        prices.reset_landing(wh)
    elif a.job == "load":
        staging.stage_new(wh)
        staging.refresh_companies(wh)
        run_load = load.full_load if a.full else load.incremental_load
        run_load(wh, a.minutes, a.only_clean)
        if a.clear_bars:
            control.clear_bars(wh)
    else:
        staging.refresh_companies(wh)
        landing = spark.readStream.schema(layout("landing_prices")).parquet(wh.path("landing_prices"))
        stream_load(wh, landing, wh.path("_stream_state"), a.minutes, every=a.every).awaitTermination()


if __name__ == "__main__":
    run(SparkSession.builder.appName("tickmart").getOrCreate())
