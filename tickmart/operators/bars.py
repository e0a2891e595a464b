"""Ticks to OHLCV bars, and the per-day summary that links a symbol's days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.functions.calendar import time_bucket, yyyymm


def bar_measures() -> dict[str, Column]:
    """OHLCV of a group of ticks with distinct times. Every buffer is fixed-width, so Spark
    aggregates by hash on both sides of the shuffle and a busy bar leaves each task as one row."""
    at = F.col("trade_date")
    return {
        "open": F.min_by("open_price", at),
        "high": F.max("high_price"),
        "low": F.min("low_price"),
        "close": F.max_by("close_price", at),
        "volume": F.sum("volume"),
        "trade_count": F.count("*").cast("int"),
    }


def to_bars(ticks: DataFrame, minutes: int = 15, only_clean: bool = False) -> DataFrame:
    if only_clean:
        ticks = ticks.where("_is_cleaned")
    measures = bar_measures()
    keyed = ticks.withColumn("interval_start", time_bucket(F.col("trade_date"), minutes))
    bars = keyed.groupBy(
        F.col("ticker_symbol").alias("symbol"), "symbol_type", "interval_start", "timezone"
    ).agg(*[c.alias(n) for n, c in measures.items()])
    return bars.select(
        "symbol", "symbol_type", "interval_start", "timezone", *measures,
        F.lit(f"{minutes}min").alias("granularity"),
    )


def with_month(bars: DataFrame) -> DataFrame:
    return bars.withColumn("yyyymm", yyyymm(F.col("interval_start")))


def bar_days(bars: DataFrame) -> DataFrame:
    """One row per symbol and day with bars: how many, and the last close."""
    day = F.to_date("interval_start")
    days = bars.groupBy("symbol", day.alias("trade_day")).agg(
        F.count("*").alias("n_bars"), F.max_by("close", "interval_start").alias("last_close")
    )
    return days.withColumn("yyyymm", yyyymm(F.col("trade_day")))


def day_links(days: DataFrame) -> DataFrame:
    """For each symbol and day: the close before it and the number of bars before it.

    The window runs over days, not bars or ticks: a symbol has at most 366 a year however busy it
    is, so no task gets more than the calendar allows.
    """
    w = Window.partitionBy("symbol").orderBy("trade_day")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return days.select(
        "symbol",
        "trade_day",
        F.lag("last_close").over(w).alias("close_before"),
        F.coalesce(F.sum("n_bars").over(before), F.lit(0)).alias("bars_before"),
        F.lead("trade_day").over(w).alias("next_day"),
    )


def bar_range_measures(now: Column) -> list[Column]:
    start = F.col("interval_start")
    return [
        F.to_date(F.min(start)).alias("min_date"),
        F.to_date(F.max(start)).alias("max_date"),
        F.max(F.when(start < now, start)).alias("high_water"),
        F.count("*").alias("row_count"),
    ]


def bar_range(bars: DataFrame, now: Column) -> DataFrame:
    """First and last day, high-water mark (last bar already begun at ``now``) and row count."""
    return bars.agg(*bar_range_measures(now))
