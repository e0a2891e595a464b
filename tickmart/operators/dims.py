"""Dimension rows, insert-if-absent and upsert, surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.functions.calendar import calendar_columns, yyyymm
from tickmart.functions.measures import trade_status
from tickmart.functions.text import canonical_symbol


def key_bucket(key: Column, digits: int = 2) -> Column:
    """One of 16 ** ``digits`` even buckets of a key."""
    return F.substring(F.md5(key), 1, digits)


def assign_keys(rows: DataFrame, key: str, id_column: str, start: int = 0) -> DataFrame:
    """Dense ids start+1, start+2, ... for rows with distinct ``key``.

    Ids follow (bucket, key) order, so they are the same on every run. Rows are numbered inside
    their bucket, in parallel; only the 256 bucket counts are summed in one place.
    """
    rows = rows.withColumn("_bucket", key_bucket(F.col(key)))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    numbered = rows.join(F.broadcast(offsets), "_bucket")
    ids = (F.lit(start) + F.col("_offset") + place).cast("bigint").alias(id_column)
    return numbered.select(ids, *[c for c in rows.columns if c != "_bucket"])


def highest(dim: DataFrame, id_column: str) -> int:
    return dim.agg(F.max(id_column)).first()[0] or 0


def insert_absent(existing: DataFrame, rows: DataFrame, keys: list[str], id_column: str | None = None) -> DataFrame:
    """The rows of ``rows`` whose key is not in ``existing``, with new ids when ``id_column`` is given."""
    new = rows.join(existing.select(*keys), keys, "left_anti")
    if id_column is None:
        return new.select(*existing.columns)
    return assign_keys(new, keys[-1], id_column, highest(existing, id_column)).select(*existing.columns)


def date_rows(bars: DataFrame) -> DataFrame:
    starts = bars.groupBy("interval_start").agg(
        F.min("granularity").alias("granularity"), F.min("timezone").alias("timezone")
    )
    at = F.col("interval_start")
    columns = [c.alias(n) for n, c in calendar_columns(at).items()]
    return starts.select(*columns, "granularity", "timezone", yyyymm(at).alias("yyyymm"))


def instrument_source(bars: DataFrame, companies: DataFrame) -> DataFrame:
    """Every traded symbol with its company's name and currency, if known. Bars shrink to distinct
    symbols before the join; the first type wins should a symbol have two."""
    symbols = bars.groupBy("symbol").agg(F.min("symbol_type").alias("instrument_type"))
    named = companies.select(
        canonical_symbol(F.col("symbol")).alias("_key"), F.col("company_name").alias("name"), "currency"
    )
    return (
        symbols.withColumn("_key", canonical_symbol(F.col("symbol")))
        .join(named, "_key", "left")
        .select("instrument_type", "symbol", "name", "currency")
    )


def exchange_rows(companies: DataFrame) -> DataFrame:
    return (
        companies.where("exchange is not null")
        .groupBy(F.col("exchange").alias("exchange_code"))
        .agg(F.min("exchange_full_name").alias("exchange_name"))
    )


def trade_status_rows(bars: DataFrame) -> DataFrame:
    return bars.groupBy(trade_status(F.col("trade_count")).alias("agg_status")).agg(
        F.min("trade_count").alias("agg_trade_count")
    )


def company_rows(companies: DataFrame, now: Column) -> DataFrame:
    attributes = [
        "symbol", "company_name", "ceo", "currency", "sector", "industry", "full_time_employees",
        "country", "state", "city", "zip", "address", "ipo_date", "is_active", "is_etf", "is_fund",
    ]
    return companies.select(
        *attributes,
        now.cast("timestamp_ntz").alias("row_effective_ts"),
        F.lit(None).cast("timestamp_ntz").alias("row_end_ts"),
    )


def upsert_company(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """The changed part of dim_company: new companies whole, known ones with only the name updated.

    Companies are matched by canonical symbol, and its bucket is their partition.
    """
    rows = rows.withColumn("_key", canonical_symbol(F.col("symbol")))
    known = existing.withColumn("_key", canonical_symbol(F.col("symbol")))
    names = rows.select("_key", F.col("company_name").alias("_name"))
    renamed = ~F.col("company_name").eqNullSafe(F.col("_name"))
    updated = known.join(names, "_key").where(renamed).withColumn("company_name", F.col("_name"))
    new = rows.join(known.select("_key"), "_key", "left_anti")
    new = assign_keys(new, "_key", "sk_company_id", highest(existing, "sk_company_id"))
    new = new.withColumn("key_bucket", key_bucket(F.col("_key"), digits=1))
    return updated.select(*existing.columns).unionByName(new.select(*existing.columns))
