"""Business queries over the star schema, the bars and the staged ticks."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.functions.measures import mean, percent
from tickmart.operators.bars import bar_days, day_links
from tickmart.operators.joins import lookup_join

Months = list[tuple[dt.date, dt.date]]


def _key(day: dt.date) -> int:
    return int(day.strftime("%Y%m%d")) * 1_000_000


def key_range(first: dt.date, end: dt.date, inclusive: bool = False) -> Column:
    """Fact rows from ``first`` up to midnight of ``end``, with the month range that lets Spark
    skip partitions."""
    key, month = F.col("fk_date_id"), F.col("yyyymm")
    upper = key <= _key(end) if inclusive else key < _key(end)
    last = end if inclusive else end - dt.timedelta(days=1)
    months = month.between(first.year * 100 + first.month, last.year * 100 + last.month)
    return (key >= _key(first)) & upper & months


def any_range(ranges: list[Column]) -> Column:
    keep = F.lit(False)
    for one in ranges:
        keep = keep | one
    return keep


def star_join(fact: DataFrame, dim_date: DataFrame, dim_instrument: DataFrame) -> DataFrame:
    """Fact with calendar and instrument. The month is part of the join, so a filter on it prunes
    the partitions of both. No bar start is hot: it has one row a symbol."""
    dates = dim_date.withColumnRenamed("sk_date_id", "fk_date_id")
    dated = lookup_join(fact, dates, ["yyyymm", "fk_date_id"], "inner")
    return fact_instrument_join(dated, dim_instrument)


def fact_instrument_join(fact: DataFrame, dim_instrument: DataFrame) -> DataFrame:
    instruments = dim_instrument.withColumnRenamed("sk_instrument_id", "fk_instrument_id")
    return lookup_join(fact, instruments, ["fk_instrument_id"], "inner")


def monthly_ohlcv(star: DataFrame, year: int | None = None, symbol: str | None = None) -> DataFrame:
    if year is not None:
        star = star.where(F.col("year") == year).where(F.col("yyyymm").between(year * 100 + 1, year * 100 + 12))
    if symbol is not None:
        star = star.where(F.col("symbol") == symbol)
    grouped = star.groupBy("symbol", "year", F.col("month").alias("month_number"), F.col("month_name").alias("month"))
    return grouped.agg(
        F.min_by("open_price", "fk_date_id").alias("open"),
        F.max("high_price").alias("high"),
        F.min("low_price").alias("low"),
        F.max_by("close_price", "fk_date_id").alias("close"),
        F.sum("volume").alias("volume"),
    )


def moving_average(bars: DataFrame, rows: int = 50, days: DataFrame | None = None, block: int = 4096) -> DataFrame:
    """Average close over each bar and the ``rows - 1`` before it, per symbol.

    ``bars`` has symbol, interval_start, close. A symbol's history is cut into blocks of ``block``
    consecutive bars, each carrying the last ``rows - 1`` bars of the block before as context: the
    result is that of one window per symbol, but no task holds more than block + rows bars of it.
    """
    if days is None:
        days = bar_days(bars)
    carried = rows - 1
    if block < carried:
        raise ValueError("a block must hold a whole frame")
    in_day = Window.partitionBy("symbol", "trade_day").orderBy("interval_start")
    links = day_links(days).select("symbol", "trade_day", "bars_before")
    numbered = (
        bars.withColumn("trade_day", F.to_date("interval_start"))
        .join(links, ["symbol", "trade_day"])
        .withColumn("_n", F.col("bars_before") + F.row_number().over(in_day) - 1)
    )
    own = F.expr(f"_n div {block}")
    tail = F.col("_n") % block >= block - carried
    placed = numbered.withColumn("_own", own).withColumn(
        "_block", F.explode(F.when(tail, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    frame = Window.partitionBy("symbol", "_block").orderBy("_n").rowsBetween(-carried, Window.currentRow)
    averaged = placed.select(
        "symbol", "interval_start", "close", "_own", "_block",
        F.sum("close").over(frame).alias("_sum"), F.count("close").over(frame).alias("_rows"),
    )
    average = F.round(F.col("_sum").cast("double") / F.nullif("_rows", F.lit(0)), 6)
    return averaged.where("_own = _block").select(
        "symbol", F.col("interval_start").alias("day"), "close", average.alias(f"sma_{rows}")
    )


def daily_pct_change(star: DataFrame, day: dt.date | None = None) -> DataFrame:
    """First open to last close, per symbol and day, largest gain first."""
    if day is not None:
        star = star.where(key_range(day, day + dt.timedelta(days=1)))
    daily = star.groupBy("symbol", F.col("date").alias("trade_date")).agg(
        F.min_by("open_price", "datetime").alias("open"), F.max_by("close_price", "datetime").alias("close")
    )
    change = percent(F.col("close") - F.col("open"), F.col("open"))
    return daily.withColumn("pct_change", change).orderBy(F.desc_nulls_first("pct_change"), "symbol", "trade_date")


def daily_volatility(fact_instrument: DataFrame, day: dt.date, n: int = 5) -> DataFrame:
    """The ``n`` symbols with the widest high-low range relative to the low."""
    one_day = fact_instrument.where(key_range(day, day + dt.timedelta(days=1)))
    ranges = one_day.groupBy("symbol").agg(
        F.max("high_price").alias("daily_high"), F.min("low_price").alias("daily_low")
    )
    spread = percent(F.col("daily_high") - F.col("daily_low"), F.col("daily_low"))
    return ranges.withColumn("volatility_pct", spread).orderBy(F.desc_nulls_first("volatility_pct"), "symbol").limit(n)


def _volume_and_average(rows: DataFrame, symbol: str, close: str) -> DataFrame:
    return rows.groupBy(F.col(symbol).alias("symbol")).agg(
        F.sum("volume").alias("total_volume"), mean(F.col(close)).alias("avg_price")
    )


def vol_avg_staging(ticks: DataFrame, months: Months) -> DataFrame:
    """Both ends of a range count, so a tick at midnight of the end day does. The partition of a
    tick starts in its month (staging partitions are days or months)."""
    at, part = F.col("trade_date"), F.col("trade_part")
    ranges = [
        at.between(_midnight(a), _midnight(b)) & part.between(F.lit(a.replace(day=1)), F.lit(b)) for a, b in months
    ]
    return _volume_and_average(ticks.where(any_range(ranges)), "ticker_symbol", "close_price")


def vol_avg_bars(bars: DataFrame, months: Months) -> DataFrame:
    at, month = F.col("interval_start"), F.col("yyyymm")
    ranges = [
        at.between(_midnight(a), _midnight(b)) & month.between(a.year * 100 + a.month, b.year * 100 + b.month)
        for a, b in months
    ]
    return _volume_and_average(bars.where(any_range(ranges)), "symbol", "close")


MONTHS = list(calendar.month_name)


def vol_avg_dim_filter(star: DataFrame, month_name: str, years: list[int]) -> DataFrame:
    """The months that the calendar filter implies are named as well, so that other partitions are
    skipped whichever way the calendar is joined."""
    months = [year * 100 + MONTHS.index(month_name) for year in years]
    rows = star.where((F.col("month_name") == month_name) & F.col("year").isin(years) & F.col("yyyymm").isin(months))
    return _volume_and_average(rows, "symbol", "close_price")


def vol_avg_key_range(fact_instrument: DataFrame, months: Months) -> DataFrame:
    ranges = [key_range(a, b, inclusive=True) for a, b in months]
    return _volume_and_average(fact_instrument.where(any_range(ranges)), "symbol", "close_price")


def _midnight(day: dt.date) -> Column:
    return F.lit(day).cast("timestamp_ntz")
