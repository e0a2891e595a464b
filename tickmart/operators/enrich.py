"""Bars with running VWAP, previous close and price deltas, then the fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickmart.functions import measures as m
from tickmart.functions.calendar import smart_key, yyyymm
from tickmart.functions.text import canonical_symbol
from tickmart.operators.bars import bar_days, day_links
from tickmart.operators.joins import lookup_join

FACT_MEASURES = (
    "open_price", "high_price", "low_price", "close_price", "volume", "adj_close", "vwap",
    "previous_close", "price_change", "price_change_pct", "price_range",
)


def _day_window() -> WindowSpec:
    """A symbol's bars of one day: at most as many as the day holds, however busy the symbol."""
    return Window.partitionBy("symbol", "trade_day").orderBy("interval_start")


def _running_vwap() -> Column:
    so_far = _day_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighted = (F.col("high") + F.col("low") + F.col("close")) * F.col("volume")
    return m.vwap(F.col("volume"), F.sum(weighted).over(so_far), F.sum("volume").over(so_far))


def running_vwap(bars: DataFrame) -> DataFrame:
    """Adds vwap alone, which needs no other day."""
    days = bars.withColumn("trade_day", F.to_date("interval_start"))
    return days.withColumn("vwap", _running_vwap()).drop("trade_day")


def enrich(bars: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Adds vwap and previous_close.

    Windows are cut by (symbol, day), so a symbol with a long history is spread over its days.
    What a day needs from earlier days - the close before it - comes in through ``links``
    (day_links); days absent from it are left out. One shuffle on (symbol, day) serves the join
    and both windows. Without ``links`` the bars are read twice: pass written ones.
    """
    if links is None:
        links = day_links(bar_days(bars))
    w = _day_window()
    days = bars.withColumn("trade_day", F.to_date("interval_start")).join(
        links.select("symbol", "trade_day", "close_before"), ["symbol", "trade_day"]
    )
    return days.select(
        *bars.columns,
        "trade_day",
        F.row_number().over(w).alias("bar_of_day"),
        _running_vwap().alias("vwap"),
        F.lag("close").over(w).alias("_lag"),
        "close_before",
    ).select(
        *bars.columns, "trade_day", "bar_of_day", "vwap",
        # not coalesce: a NULL close earlier in the day stays a NULL previous close
        F.when(F.col("bar_of_day") == 1, F.col("close_before")).otherwise(F.col("_lag")).alias("previous_close"),
    )


def with_flags(enriched: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Adds what the load checks of every bar: ``_repeated`` (an earlier bar of the symbol has its time)
    and ``_known_time`` (its time is in the calendar).

    The window is that of ``enrich``, so nothing is shuffled again, and the calendar comes as one row a day,
    with the times of the day.
    """
    times = dim_date.groupBy(F.col("date").alias("trade_day")).agg(F.collect_set("sk_date_id").alias("_times"))
    at = smart_key(F.col("interval_start"))
    before = F.lag(at).over(_day_window())
    flagged = enriched.withColumn("_repeated", F.coalesce(before == at, F.lit(False)))
    flagged = lookup_join(flagged, times, ["trade_day"])
    return flagged.withColumn("_known_time", F.coalesce(F.array_contains("_times", at), F.lit(False))).drop("_times")


def price_metrics(enriched: DataFrame) -> DataFrame:
    close, previous = F.col("close"), F.col("previous_close")
    return enriched.withColumns(
        {
            "adj_close": close,
            "price_change": m.price_change(close, previous),
            "price_change_pct": m.price_change_pct(close, previous),
            "price_range": m.price_range(F.col("high"), F.col("low")),
        }
    )


def exchange_lookup(companies: DataFrame, dim_exchange: DataFrame) -> DataFrame:
    """symbol key -> exchange id."""
    codes = companies.select(canonical_symbol(F.col("symbol")).alias("_key"), F.col("exchange").alias("exchange_code"))
    return codes.join(dim_exchange.select("exchange_code", "sk_exchange_id"), "exchange_code", "left").select(
        "_key", "sk_exchange_id"
    )


def symbol_keys(dim_instrument: DataFrame, dim_company: DataFrame, companies: DataFrame, dim_exchange: DataFrame) -> DataFrame:
    """One row per traded symbol with its three dimension ids, so that bars are joined once."""
    keyed = dim_instrument.select(
        "symbol", F.col("sk_instrument_id").alias("fk_instrument_id"), canonical_symbol(F.col("symbol")).alias("_key")
    )
    company = dim_company.select(
        canonical_symbol(F.col("symbol")).alias("_key"), F.col("sk_company_id").alias("fk_company_id")
    )
    exchange = exchange_lookup(companies, dim_exchange).withColumnRenamed("sk_exchange_id", "fk_exchange_id")
    return keyed.join(company, "_key", "left").join(exchange, "_key", "left").drop("_key")


def fact_rows(enriched: DataFrame, keys: DataFrame, dim_trade_status: DataFrame, audit_id: int, also: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows from enriched bars. ``keys`` (symbol_keys) should be written or small. Columns named in
    ``also`` come along."""
    status = dim_trade_status.select(F.col("agg_status").alias("_status"), F.col("sk_status_id").alias("fk_status_id"))
    rows = price_metrics(enriched).withColumn("_status", m.trade_status(F.col("trade_count")))
    # three statuses at most
    rows = rows.join(F.broadcast(status), "_status", "left")
    rows = lookup_join(rows, keys, ["symbol"])
    return rows.select(
        smart_key(F.col("interval_start")).alias("fk_date_id"),
        "fk_instrument_id",
        "fk_exchange_id",
        F.lit(audit_id).cast("bigint").alias("fk_audit_id"),
        "fk_company_id",
        "fk_status_id",
        *[F.col(p).alias(f"{p}_price") for p in ("open", "high", "low", "close")],
        *FACT_MEASURES[4:],
        yyyymm(F.col("interval_start")).alias("yyyymm"),
        *also,
    )
