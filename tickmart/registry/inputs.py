"""Ticks, landed text and profiles derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions import text
from tickmart.operators.validate import clean_flag, dedup_prices
from tickmart.schemas import PROFILE_TEXT

PRICE = "decimal(18,6)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ohlc(opened: Column, move: Column) -> dict[str, Column]:
    close = (opened + move.cast(PRICE)).cast(PRICE)
    margin = F.lit("0.05").cast(PRICE)
    return {
        "open_price": opened,
        "close_price": close,
        "high_price": (F.greatest(opened, close) + margin).cast(PRICE),
        "low_price": (F.least(opened, close) - margin).cast(PRICE),
    }


def _tick_columns(order: list[str]) -> list[str]:
    return [
        "ticker_symbol", "trade_date", "timezone", "open_price", "high_price", "low_price",
        "close_price", "volume", "symbol_type", *order,
    ]


def ticks_e(spark: SparkSession, sf: str) -> DataFrame:
    """Domain E: one tick per event, around the clock."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    opened = (F.col("value").cast("decimal(17,6)") + 100).cast(PRICE)
    kind = F.col("event_type")
    columns = {
        "ticker_symbol": F.upper(kind),
        "trade_date": F.col("ts"),
        "timezone": F.lit(text.TIMEZONE_LABEL),
        "symbol_type": F.when(kind == "signup", "bond")
        .when(kind == "error", "index")
        .when(kind == "purchase", "commodity")
        .otherwise("stock"),
        **_ohlc(opened, (k - 50) * F.lit("0.01").cast("decimal(9,2)")),
        "volume": (F.col("user_id") % 50 * 10).cast("bigint"),
    }
    return table(spark, sf, "events").withColumns(columns).select(*_tick_columns(["event_id"]))


def landing_e(spark: SparkSession, sf: str) -> DataFrame:
    """Domain E as landed text with flaws: every tick once, and some a second time in a later load."""
    at = F.col("event_id")

    def flawed(every: int, bad: Column, good: Column) -> Column:
        return F.when(at % every == 0, bad).otherwise(good)

    stamp = F.date_format("trade_date", "yyyy-MM-dd HH:mm:ss")
    texts = {c: F.col(f"{c}_price").cast("string") for c in ("open", "high", "low", "close")}
    volume = F.col("volume").cast("string")
    # flaws, not a selection: no row is left out
    loads = F.explode(flawed(97, F.array(F.lit(0), F.lit(1)), F.array(F.lit(0))))
    return ticks_e(spark, sf).select(
        F.col("ticker_symbol").alias("symbol"),
        flawed(11, F.concat(F.lit("  "), stamp, F.lit(" ")), stamp).alias("date"),
        flawed(89, F.lit(""), flawed(101, F.lit("abc"), texts["open"])).alias("open"),
        flawed(79, texts["low"], texts["high"]).alias("high"),
        flawed(79, texts["high"], texts["low"]).alias("low"),
        flawed(73, F.concat(F.lit("-"), texts["close"]), texts["close"]).alias("close"),
        flawed(83, F.lit(" "), F.when(at % 2 == 1, F.concat(volume, F.lit(".0"))).otherwise(volume)).alias("volume"),
        at,
        loads.alias("copy"),
    )


def lineage_e(landing: DataFrame) -> DataFrame:
    """Lineage of landing_e: a file per symbol, the second copies loaded a day later."""
    return landing.withColumns(
        {
            "_source_name": F.lit("CSV Import"),
            "_source_filename": F.concat("symbol", F.lit(".csv")),
            "_loaded_at": F.expr("timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(copy)"),
        }
    )


def raw_ticks_l(spark: SparkSession, sf: str) -> DataFrame:
    """Domain L: one tick per line item, in trading hours; times repeat."""
    slot = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 78
    digit = F.col("l_suppkey") % 10
    opened = F.col("l_extendedprice").cast(PRICE)
    columns = {
        "ticker_symbol": F.concat(F.lit("S"), digit.cast("string")),
        "trade_date": F.col("l_shipdate") + F.make_dt_interval(mins=(slot * 5 + 570).cast("int")),
        "timezone": F.lit(text.TIMEZONE_LABEL),
        "symbol_type": F.when(digit == 7, "bond").when(digit == 8, "index").when(digit == 9, "commodity").otherwise("stock"),
        **_ohlc(opened, (F.col("l_linenumber") - 4) * F.lit("0.25").cast("decimal(9,2)")),
        "volume": F.col("l_quantity").cast("bigint"),
    }
    return table(spark, sf, "lineitem").withColumns(columns).select(*_tick_columns(["l_orderkey", "l_linenumber"]))


def ticks_l(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_prices(raw_ticks_l(spark, sf), order=("l_orderkey", "l_linenumber"))


def staged(ticks: DataFrame) -> DataFrame:
    """Ticks in the layout of staging."""
    rows = ticks if "_is_duplicate" in ticks.columns else ticks.withColumn("_is_duplicate", F.lit(False))
    return rows.withColumns(
        {
            "_source_name": F.lit("CSV Import"),
            "_source_filename": F.concat("ticker_symbol", F.lit(".csv")),
            "_is_cleaned": clean_flag(),
            "_audit_hash": text.audit_hash(
                F.col("ticker_symbol"), F.col("trade_date").cast("string"), F.col("close_price").cast("string")
            ),
            "_loaded_at": F.expr("timestamp_ntz'2024-02-01 00:00:00'"),
        }
    ).drop("event_id", "l_orderkey", "l_linenumber")


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Landed profiles: one per supplier, several versions of most companies. T9 is not traded, and
    S9, which is, has no profile."""
    digit = (F.col("s_suppkey") % 10).cast("string")
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    known = {
        "symbol": F.concat(F.when(digit == "9", "T").otherwise("S"), digit),
        "company_name": F.col("s_name"),
        "sector": F.col("n_name"),
        "currency": F.lit("USD"),
        "exchange": F.concat(F.lit("X"), F.col("n_regionkey").cast("string")),
        "exchange_full_name": F.col("n_name"),
        "full_time_employees": (F.col("s_suppkey") * 10).cast("string"),
        "ipo_date": F.lit("1990-01-02"),
        "is_active": F.lit("true"),
        "is_etf": F.lit("false"),
        "is_fund": F.when(F.col("s_suppkey") % 2 == 0, "true").otherwise("false"),
    }
    day = F.col("s_suppkey").cast("int")
    return rows.select(
        *[known.get(c, F.lit(None).cast("string")).alias(c) for c in PROFILE_TEXT],
        F.lit("API Import").alias("_source_name"),
        F.lit("profiles").alias("_source_filename"),
        (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(day)).alias("_loaded_at"),
    )
