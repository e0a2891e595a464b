"""One query per operator, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions import measures, text
from tickmart.functions.calendar import time_bucket
from tickmart.operators import checks, dims, marts
from tickmart.operators import validate as v
from tickmart.operators.bars import bar_days, bar_range, to_bars, with_month
from tickmart.operators.enrich import enrich, exchange_lookup, price_metrics, running_vwap
from tickmart.plans import control, load, staging
from tickmart.registry import inputs as i
from tickmart.session import materialize, scratch_path
from tickmart.sources import prices, profiles
from tickmart.sources.deltas import Changes
from tickmart.sources.tables import Warehouse
from tickmart.streaming import stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = dt.datetime(2024, 1, 20)
DAY = dt.date(2024, 1, 15)
MARCH = [(dt.date(y, 3, 1), dt.date(y, 4, 1)) for y in (1996, 1998)]

_warehouses: dict[tuple[str, str, str], Warehouse] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def named(name: str) -> Callable[[Query], Query]:
    """For names that are taken by what the query calls."""

    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


def fresh(spark: SparkSession, name: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, name))


def _stage(wh: Warehouse, ticks: DataFrame, sf: str) -> Warehouse:
    staging.append_staging(wh, i.staged(ticks), 1)
    wh.append(i.profiles(wh.spark, sf), "landing_profiles")
    staging.refresh_companies(wh)
    return wh


def once(spark: SparkSession, sf: str, name: str, build: Callable[[], Warehouse]) -> Warehouse:
    """A warehouse that several queries read, built once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _warehouses or not _is_there(_warehouses[key]):
        _warehouses[key] = build()
    return _warehouses[key]


def loaded(spark: SparkSession, sf: str, domain: str) -> Warehouse:
    """The star schema of a domain by full load."""

    def build() -> Warehouse:
        ticks = {"E": i.ticks_e, "L": i.ticks_l}[domain](spark, sf)
        wh = _stage(fresh(spark, f"warehouse_{domain}"), ticks, sf)
        load.full_load(wh)
        return wh

    return once(spark, sf, domain, build)


def _is_there(wh: Warehouse) -> bool:
    try:
        wh.spark.read.parquet(wh.path("elt_control"))
        return True
    except AnalysisException:
        return False


def ntz(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def bars_e(spark: SparkSession, sf: str) -> DataFrame:
    return to_bars(i.ticks_e(spark, sf))


def bars_l(spark: SparkSession, sf: str) -> DataFrame:
    return to_bars(i.ticks_l(spark, sf))


# --- sources and landing -------------------------------------------------------------------------

LANDED = ["symbol", "date", "open", "high", "low", "close", "volume"]


def _write_price_files(spark: SparkSession, sf: str, broken: bool = False) -> str:
    """landing_e as CSV folders per symbol: most in the usual column order, one symbol in another
    with a column too many and, if asked for, one without prices."""
    path = scratch_path(spark, "price_files")
    rows = i.landing_e(spark, sf)

    def write(df: DataFrame, columns: list[str], folder: str) -> None:
        writer = df.select(*columns).write.option("header", True)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.partitionBy("symbol").csv(f"{path}/{folder}")

    write(rows.where("symbol <> 'ERROR'"), LANDED, "usual")
    write(rows.where("symbol = 'ERROR'"), ["volume", "close", "event_id", *LANDED[:5]], "reordered")
    if broken:
        write(rows.withColumn("symbol", F.concat("symbol", F.lit("_BAD"))), ["symbol", "date", "open"], "broken")
    return path


@query
def land_prices(spark, sf):
    wh = fresh(spark, "landing")
    prices.land_prices(wh, _write_price_files(spark, sf))
    return wh.read("landing_prices").select(*LANDED)


@query
def ingest_log(spark, sf):
    wh = fresh(spark, "landing")
    prices.land_prices(wh, _write_price_files(spark, sf, broken=True))
    log = wh.read("ingest_log")
    return log.groupBy("symbol", "status", "error").agg(F.sum("rows").alias("rows"))


@query
def tag_lineage(spark, sf):
    rows = i.landing_e(spark, sf).select(*LANDED)
    tagged = prices.tag_lineage(rows, prices.SOURCE_NAME, F.concat("symbol", F.lit(".csv")))
    return tagged.drop("_loaded_at")


def _landing_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    rows = i.lineage_e(i.landing_e(spark, sf))
    return [rows.where(f"copy = {n}").drop("copy", "event_id") for n in (0, 1)]


@query
def append_landing(spark, sf):
    wh = fresh(spark, "landing")
    for batch in _landing_batches(spark, sf):
        prices.append_landing(wh, batch)
    return wh.read("landing_prices").drop("load_date", "_path", "_landing")


@query
def reset_landing(spark, sf):
    """Landing after a load, a reset and the whole once more."""
    wh = fresh(spark, "landing")
    first, second = _landing_batches(spark, sf)
    prices.append_landing(wh, first)
    prices.reset_landing(wh)
    prices.append_landing(wh, first.unionByName(second))
    return wh.read("landing_prices").drop("load_date", "_path", "_landing")


@query
def canonical_symbol(spark, sf):
    """Symbols in several spellings, by event."""
    mark = F.element_at(F.array(*[F.lit(c) for c in ("", "_", "-", ".")]), (F.col("event_id") % 4 + 1).cast("int"))
    symbol = F.concat(F.substring("ticker_symbol", 1, 2), mark, F.substring("ticker_symbol", 3, 20))
    rows = i.ticks_e(spark, sf).select("event_id", symbol.alias("symbol"))
    return rows.select(
        "event_id", "symbol", text.canonical_symbol(F.col("symbol")).alias("key"),
        text.api_symbol(F.col("symbol")).alias("api_symbol"),
    )


@query
def land_sectors(spark, sf):
    wh, path = fresh(spark, "landing"), scratch_path(spark, "sector_files")
    companies(spark, sf).select("symbol", "sector").write.option("header", True).csv(path)
    profiles.land_sectors(wh, path)
    return wh.read("landing_sectors").select("symbol", "sector", "_source_name")


@query
def land_profiles(spark, sf):
    wh, path = fresh(spark, "landing"), scratch_path(spark, "profile_files")
    rows = i.profiles(spark, sf)
    flags = ("is_active", "is_etf", "is_fund")
    fields = [(F.col(c).cast("boolean") if c in flags else F.col(c)).alias(profiles.json_field(c)) for c in i.PROFILE_TEXT]
    rows.select(F.to_json(F.array(F.struct(*fields)))).write.text(path)
    profiles.land_profiles(wh, path, whole_files=False)
    return wh.read("landing_profiles").select(*i.PROFILE_TEXT, "_source_name")


# --- validation ----------------------------------------------------------------------------------

EXTRA = ("copy", "event_id")


def typed_e(spark: SparkSession, sf: str) -> DataFrame:
    return v.type_prices(i.landing_e(spark, sf), extra=EXTRA)


@query
def type_prices(spark, sf):
    return typed_e(spark, sf)


@query
def rejected_prices(spark, sf):
    return v.rejected_prices(i.landing_e(spark, sf)).select(*EXTRA, *LANDED, "reject_reason")


@query
def parse_trade_date(spark, sf):
    return i.landing_e(spark, sf).select(*EXTRA, "date", text.to_trade_date(F.col("date")).alias("trade_date"))


@query
def repair_volume(spark, sf):
    rows = i.landing_e(spark, sf).select(*EXTRA, F.col("volume").alias("volume_text"))
    return rows.withColumn("volume", text.to_volume(F.col("volume_text")))


SPECIAL = ("IRX", "FVX", "TNX", "DJI", "IXIC", "GSPC", "GCF", "CLF")


@query
def classify_symbol(spark, sf):
    """Every line item's symbol, the eight that are not stocks among them."""
    digit = (F.col("l_suppkey") % 10).cast("int")
    symbol = F.coalesce(F.get(F.array(*[F.lit(s) for s in SPECIAL]), digit), F.concat(F.lit("S"), digit.cast("string")))
    symbols = i.table(spark, sf, "lineitem").select(symbol.alias("symbol")).distinct()
    return symbols.withColumn("symbol_type", text.classify_symbol(F.col("symbol")))


@query
def audit_hash(spark, sf):
    hashed = text.audit_hash(F.col("symbol"), F.col("date"), F.col("close")).alias("_audit_hash")
    return i.landing_e(spark, sf).select(*EXTRA, hashed)


FLAGGED = [*v.TICK_KEY, "copy", "event_id", "_is_duplicate"]


@query
def dup_flag(spark, sf):
    return v.dup_flag(typed_e(spark, sf), list(EXTRA)).select(*FLAGGED)


def deduped_e(spark: SparkSession, sf: str) -> DataFrame:
    return v.dedup_prices(typed_e(spark, sf), order=EXTRA)


@query
def dup_flag_after(spark, sf):
    return v.dup_flag(deduped_e(spark, sf).drop("_is_duplicate"), list(EXTRA)).select(*FLAGGED)


@query
def dedup_prices(spark, sf):
    return deduped_e(spark, sf).select(*FLAGGED, "close_price", "reject_reason")


@query
def dedup_prices_l(spark, sf):
    return i.ticks_l(spark, sf)


@query
def clean_flag(spark, sf):
    return deduped_e(spark, sf).select("event_id", v.clean_flag().alias("_is_cleaned"))


STAGED = [
    "ticker_symbol", "trade_date", "timezone", "open_price", "high_price", "low_price", "close_price",
    "volume", "symbol_type", "_source_name", "_source_filename", "_is_cleaned", "_is_duplicate", "_audit_hash",
]


@query
def append_staging(spark, sf):
    """The two loads of landing_e as two batches, the second staged twice."""
    wh = fresh(spark, "staging")
    first, second = _landing_batches(spark, sf)
    for landing, batch_id in ((first, 1), (second, 2), (second, 2)):
        staging.stage_batch(wh, landing, batch_id)
    return staging.read_staging(wh).select(*STAGED)


COMPANY = [
    "symbol", "company_name", "currency", "sector", "full_time_employees", "exchange",
    "exchange_full_name", "ipo_date", "is_active", "is_etf", "is_fund",
]


@query
def latest_profile(spark, sf):
    return v.latest_profile(i.profiles(spark, sf)).select(*COMPANY)


@query
def snapshot_companies(spark, sf):
    """Staged companies after a second collection."""
    wh = fresh(spark, "companies")
    rows = i.profiles(spark, sf)
    half = F.expr("timestamp_ntz'2024-01-11 00:00:00'")
    for part in (rows.where(F.col("_loaded_at") < half), rows.where(F.col("_loaded_at") >= half)):
        wh.append(part, "landing_profiles")
        staging.refresh_companies(wh)
    return wh.read("stg_companies").select(*COMPANY)


# --- bars and windows ----------------------------------------------------------------------------


@query
def bars_15min(spark, sf):
    return bars_e(spark, sf)


@query
def bars_15min_l(spark, sf):
    return bars_l(spark, sf)


@query
def bars_5min(spark, sf):
    return to_bars(i.ticks_e(spark, sf), minutes=5)


@query
def bars_only_clean(spark, sf):
    ticks = deduped_e(spark, sf).withColumn("_is_cleaned", v.clean_flag())
    return to_bars(ticks, only_clean=True)


@named("time_bucket")
def time_buckets(spark, sf):
    at = F.col("trade_date")
    return i.ticks_e(spark, sf).select(
        "event_id", time_bucket(at, 15).alias("by_15"), time_bucket(at, 7).alias("by_7"), time_bucket(at, 45).alias("by_45")
    )



@named("bar_range")
def bar_range_e(spark, sf):
    return bar_range(bars_e(spark, sf), ntz(NOW))


BAR = ["symbol", "interval_start"]


@named("price_metrics")
def price_metrics_e(spark, sf):
    rows = price_metrics(enrich(materialize(bars_e(spark, sf), "bars")))
    return rows.select(*BAR, "adj_close", "price_change", "price_change_pct", "price_range")



@query
def trade_status(spark, sf):
    return bars_e(spark, sf).select(*BAR, "trade_count", measures.trade_status(F.col("trade_count")).alias("agg_status"))


@query
def vwap(spark, sf):
    return running_vwap(bars_e(spark, sf)).select(*BAR, "vwap")


@query
def vwap_l(spark, sf):
    return running_vwap(bars_l(spark, sf)).select(*BAR, "vwap")


@query
def previous_close(spark, sf):
    return enrich(materialize(bars_e(spark, sf), "bars")).select(*BAR, "previous_close")


@query
def previous_close_l(spark, sf):
    return enrich(materialize(bars_l(spark, sf), "bars")).select(*BAR, "previous_close")


@query
def sma_50(spark, sf):
    return marts.moving_average(materialize(bars_e(spark, sf), "bars"), block=256)


# --- business queries ----------------------------------------------------------------------------


def star(spark: SparkSession, sf: str, domain: str) -> DataFrame:
    wh = loaded(spark, sf, domain)
    return marts.star_join(wh.read("fact_15min_stock_price"), wh.read("dim_date"), wh.read("dim_instrument"))


def fact_instruments(spark: SparkSession, sf: str, domain: str) -> DataFrame:
    wh = loaded(spark, sf, domain)
    return marts.fact_instrument_join(wh.read("fact_15min_stock_price"), wh.read("dim_instrument"))


@query
def sma_50_fact(spark, sf):
    """The moving average over the star schema, every symbol, with the stored day summary."""
    wh = loaded(spark, sf, "L")
    rows = star(spark, sf, "L").select("symbol", F.col("datetime").alias("interval_start"), F.col("close_price").alias("close"))
    return marts.moving_average(rows, days=wh.read("bar_days")).orderBy("symbol", F.desc("day"))


@query
def monthly_ohlcv(spark, sf):
    return marts.monthly_ohlcv(star(spark, sf, "L"), year=1998).orderBy("symbol", "month_number")


@query
def monthly_ohlcv_all(spark, sf):
    return marts.monthly_ohlcv(star(spark, sf, "L"))


@query
def monthly_ohlcv_symbol(spark, sf):
    """One symbol and one year."""
    return marts.monthly_ohlcv(star(spark, sf, "L"), year=1998, symbol="S1").orderBy("month_number")


@query
def daily_pct_change(spark, sf):
    return marts.daily_pct_change(star(spark, sf, "E"), DAY)


@query
def daily_pct_change_all(spark, sf):
    return marts.daily_pct_change(star(spark, sf, "L"))


@query
def daily_volatility_top5(spark, sf):
    return marts.daily_volatility(fact_instruments(spark, sf, "E"), DAY, 5)


@query
def vol_avg_staging(spark, sf):
    return marts.vol_avg_staging(staging.read_staging(loaded(spark, sf, "L")), MARCH)


@query
def vol_avg_bars(spark, sf):
    return marts.vol_avg_bars(loaded(spark, sf, "L").read("agg_15min_raw"), MARCH)


@query
def vol_avg_dim_filter(spark, sf):
    return marts.vol_avg_dim_filter(star(spark, sf, "L"), "March", [1996, 1998])


@query
def vol_avg_key_range(spark, sf):
    return marts.vol_avg_key_range(fact_instruments(spark, sf, "L"), MARCH)


# --- star schema ---------------------------------------------------------------------------------


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return v.latest_profile(i.profiles(spark, sf))


@query
def instrument_source(spark, sf):
    return dims.instrument_source(bars_l(spark, sf), companies(spark, sf))


@named("exchange_lookup")
def exchange_of_symbol(spark, sf):
    """Exchange of every traded symbol, NULL where there is no profile."""
    staged_companies = companies(spark, sf)
    exchanges = dims.assign_keys(dims.exchange_rows(staged_companies), "exchange_code", "sk_exchange_id")
    symbols = bars_l(spark, sf).select("symbol").distinct()
    found = symbols.withColumn("_key", text.canonical_symbol(F.col("symbol")))
    found = found.join(exchange_lookup(staged_companies, exchanges), "_key", "left")
    return found.join(exchanges, "sk_exchange_id", "left").select("symbol", "exchange_code", "exchange_name")


KEYED = ["fk_instrument_id", "fk_company_id", "fk_exchange_id", "fk_status_id"]


def _keyed_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Facts with the natural key behind each surrogate one."""
    wh = loaded(spark, sf, "L")
    rows = wh.read("fact_15min_stock_price")
    lookups = {
        "fk_instrument_id": wh.read("dim_instrument").selectExpr("sk_instrument_id fk_instrument_id", "symbol"),
        "fk_company_id": wh.read("dim_company").selectExpr("sk_company_id fk_company_id", "company_name"),
        "fk_exchange_id": wh.read("dim_exchange").selectExpr("sk_exchange_id fk_exchange_id", "exchange_code"),
        "fk_status_id": wh.read("dim_trade_status").selectExpr("sk_status_id fk_status_id", "agg_status"),
    }
    for key, lookup in lookups.items():
        rows = marts.lookup_join(rows, lookup, [key])
    return rows


@query
def status_lookup(spark, sf):
    return _keyed_fact(spark, sf).select("symbol", "fk_date_id", "agg_status")


@query
def fact_keys(spark, sf):
    return _keyed_fact(spark, sf).select("symbol", "fk_date_id", "company_name", "exchange_code", "agg_status")


@query
def fact_build(spark, sf):
    return _keyed_fact(spark, sf).drop(*KEYED, "yyyymm")


@query
def star_join(spark, sf):
    return star(spark, sf, "L").select(
        "symbol", "instrument_type", "datetime", "date", "month_name", "year", "is_early_close",
        "open_price", "high_price", "low_price", "close_price", "volume",
    )


@query
def fact_instrument_join(spark, sf):
    return fact_instruments(spark, sf, "L").select("fk_date_id", "symbol", "name", "currency", "close_price", "volume")


@query
def dim_date(spark, sf):
    return dims.date_rows(bars_l(spark, sf)).drop("yyyymm")


@query
def dim_date_e(spark, sf):
    """Bar starts around the clock, so every session flag occurs."""
    return dims.date_rows(bars_e(spark, sf)).drop("yyyymm")


def _split_by_time(spark: SparkSession, sf: str) -> list[DataFrame]:
    rows = i.profiles(spark, sf)
    half = F.expr("timestamp_ntz'2024-01-11 00:00:00'")
    return [v.latest_profile(p) for p in (rows.where(F.col("_loaded_at") < half), rows)]


@query
def dim_company(spark, sf):
    """Two loads: in the second, known companies take the new name only."""
    wh = fresh(spark, "dim_company")
    for batch, staged_companies in enumerate(_split_by_time(spark, sf)):
        rows = dims.company_rows(staged_companies, ntz(dt.datetime(2024, 3, batch + 1)))
        changed = materialize(dims.upsert_company(wh.read("dim_company"), rows), "dim_company")
        wh.upsert(changed, "dim_company", ["sk_company_id"])
    return wh.read("dim_company").select(
        "symbol", "company_name", "sector", "currency", "full_time_employees", "ipo_date",
        "is_active", "is_etf", "is_fund", "row_effective_ts", "row_end_ts",
    )


def _insert_twice(spark: SparkSession, name: str, batches: list[DataFrame], keys: list[str], id_column: str) -> DataFrame:
    wh = fresh(spark, name)
    for rows in batches:
        wh.append(dims.insert_absent(wh.read(name), rows, keys, id_column), name)
    return wh.read(name)


@query
def dim_instrument(spark, sf):
    batches = [dims.instrument_source(bars_l(spark, sf), c) for c in _split_by_time(spark, sf)]
    return _insert_twice(spark, "dim_instrument", batches, ["symbol"], "sk_instrument_id")


@query
def dim_exchange(spark, sf):
    batches = [dims.exchange_rows(c) for c in _split_by_time(spark, sf)]
    return _insert_twice(spark, "dim_exchange", batches, ["exchange_code"], "sk_exchange_id")


@query
def dim_trade_status(spark, sf):
    batches = [dims.trade_status_rows(b) for b in (bars_e(spark, sf), bars_l(spark, sf))]
    return _insert_twice(spark, "dim_trade_status", batches, ["agg_status"], "sk_status_id")


@query
def surrogate_keys(spark, sf):
    """Dense ids for every distinct bar start, after the first hundred were taken."""
    starts = bars_l(spark, sf).select(F.date_format("interval_start", "yyyyMMddHHmmss").alias("key")).distinct()
    return dims.assign_keys(starts, "key", "id", start=100)


# --- writers, incremental loads, streams ---------------------------------------------------------


@query
def bars_upsert(spark, sf):
    """Bars of all ticks but the last ten days, then bars of the whole, replacing by key."""
    wh = fresh(spark, "bars_upsert")
    ticks = i.ticks_e(spark, sf)
    for part in (ticks.where("trade_date < timestamp_ntz'2024-01-20 07:40:00'"), ticks):
        changes = Changes(wh)
        changes.put("agg_15min_raw", materialize(with_month(to_bars(part)), "bars"))
        changes.commit()
    return wh.read("agg_15min_raw").drop("yyyymm")


NATURAL = ["symbol", "fk_date_id", *[
    "open_price", "high_price", "low_price", "close_price", "volume", "adj_close", "vwap",
    "previous_close", "price_change", "price_change_pct", "price_range",
]]


def natural_fact(wh: Warehouse) -> DataFrame:
    rows = marts.fact_instrument_join(wh.read("fact_15min_stock_price"), wh.read("dim_instrument"))
    return rows.select(*NATURAL)


def _deal(ticks: DataFrame) -> DataFrame:
    """All ticks, dealt to three arrival batches without regard to time."""
    return ticks.withColumn("batch", F.col("event_id") % 3 + 1)


def in_three_batches(spark: SparkSession, sf: str) -> Warehouse:
    """The star schema of domain E by incremental loads."""

    def build() -> Warehouse:
        wh = fresh(spark, "three_batches")
        dealt = _deal(i.ticks_e(spark, sf))
        for batch_id in (1, 2, 3):
            staging.append_staging(wh, i.staged(dealt.where(F.col("batch") == batch_id)), batch_id)
            load.incremental_load(wh)
        return wh

    return once(spark, sf, "three batches", build)


@query
def fact_upsert(spark, sf):
    """Facts of a full load replaced by those of another: twice the load, once the rows."""
    wh = _stage(fresh(spark, "fact_upsert"), i.ticks_l(spark, sf), sf)
    load.full_load(wh)
    again = materialize(wh.read("fact_15min_stock_price").withColumn("fk_audit_id", F.lit(2).cast("bigint")), "facts")
    changes = Changes(wh)
    changes.put("fact_15min_stock_price", again)
    changes.commit()
    rows = marts.fact_instrument_join(wh.read("fact_15min_stock_price"), wh.read("dim_instrument"))
    return rows.select(*NATURAL, "fk_audit_id")


@query
def monthly_partitions(spark, sf):
    """Facts per month folder."""
    facts = loaded(spark, sf, "L").read("fact_15min_stock_price")
    return facts.groupBy("yyyymm").agg(
        F.count("*").alias("rows"), F.min("fk_date_id").alias("first_key"), F.max("fk_date_id").alias("last_key")
    )


@named("incremental_filter")
def incremental_filter_e(spark, sf):
    """Ticks of the batches after the first."""
    wh = fresh(spark, "incremental_filter")
    dealt = _deal(i.ticks_e(spark, sf))
    for batch_id in (1, 2, 3):
        staging.append_staging(wh, i.staged(dealt.where(F.col("batch") == batch_id)), batch_id)
    return staging.new_batches(wh, 1)[0].select("ticker_symbol", "trade_date", "_batch_id")



@query
def bars_incremental(spark, sf):
    return in_three_batches(spark, sf).read("agg_15min_raw").drop("yyyymm")


@query
def fact_incremental(spark, sf):
    return natural_fact(in_three_batches(spark, sf))


@query
def full_load(spark, sf):
    return natural_fact(loaded(spark, sf, "L"))


@query
def audit_run(spark, sf):
    """The run record, without its clock columns."""
    log = loaded(spark, sf, "E").read("dim_meta_audit_log")
    return log.select("sk_audit_id", "source_system", "row_count_raw", "row_count_rejected", "status")


@query
def control_high_water(spark, sf):
    row = loaded(spark, sf, "E").read("elt_control")
    return row.select("id", "job_name", "last_processed", "last_batch_id", "status")


@query
def clear_bars(spark, sf):
    """Rows left in each table after the bars of a completed load are cleared."""
    wh = _stage(fresh(spark, "clear_bars"), i.ticks_e(spark, sf), sf)
    load.full_load(wh)
    control.clear_bars(wh)
    counts = [
        wh.read(t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in ("agg_15min_raw", "fact_15min_stock_price")
    ]
    return counts[0].unionByName(counts[1])


def _tick_files(spark: SparkSession, ticks: DataFrame) -> tuple[str, str]:
    path = scratch_path(spark, "tick_files")
    ticks.write.parquet(path)
    return path, scratch_path(spark, "stream_state")


def _tick_stream(spark: SparkSession, ticks: DataFrame) -> tuple[DataFrame, str]:
    path, state = _tick_files(spark, ticks)
    return spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 4).parquet(path), state


@query
def stream_bars(spark, sf):
    wh = fresh(spark, "stream_bars")
    ticks, state = _tick_stream(spark, i.ticks_e(spark, sf).repartition(8, "event_id"))
    stream.stream_bars(wh, ticks, state, watermark="60 days", every=None).awaitTermination()
    return wh.read("agg_15min_raw").drop("yyyymm")


@query
def stream_bars_7min(spark, sf):
    """A width that does not divide the hour."""
    wh = fresh(spark, "stream_bars")
    ticks, state = _tick_stream(spark, i.ticks_e(spark, sf).repartition(8, "event_id"))
    stream.stream_bars(wh, ticks, state, minutes=7, watermark="60 days", every=None).awaitTermination()
    return wh.read("agg_15min_raw").drop("yyyymm")


class _BrokeOff(Exception):
    pass


@query
def staging_retry(spark, sf):
    """A batch that broke off in the middle, and again after staging, each time with a load before the
    retry, then another landing: the first is staged again, the second after it, and the load has all
    ticks."""
    wh = fresh(spark, "staging_retry")
    rows = i.lineage_e(i.landing_e(spark, sf))
    prices.append_landing(wh, rows.where("event_id % 2 = 0").drop("copy", "event_id"))
    begun = staging.begin_batch(wh)
    with suppress(_BrokeOff), staging.attempt(wh, begun):
        staging.log_parts(wh, begun, [dt.date(2024, 1, 1)])
        raise _BrokeOff
    load.incremental_load(wh)
    staging.stage_batch(wh, staging.batch_landing(wh, begun), begun)
    load.incremental_load(wh)
    prices.append_landing(wh, rows.where("event_id % 2 = 1").drop("copy", "event_id"))
    while staging.stage_new(wh) is not None:
        load.incremental_load(wh)
    return natural_fact(wh)


def _clean_then_flawed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All ticks without flaws, and as landed later, with flaws."""
    day = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    earlier = i.staged(i.ticks_e(spark, sf)).withColumns({"_loaded_at": day, "symbol_type": text.classify_symbol(F.col("ticker_symbol"))})
    # landed text has whole seconds
    earlier = v.dedup_prices(earlier.withColumn("trade_date", F.date_trunc("second", "trade_date").cast("timestamp_ntz")), was_duplicate="_is_duplicate")
    return earlier, v.stage_prices(i.lineage_e(i.landing_e(spark, sf)).drop("copy", "event_id"))


@query
def incremental_only_clean(spark, sf):
    """Bars of clean ticks alone, by two loads: the second takes some bars away."""
    wh = fresh(spark, "only_clean")
    for batch_id, ticks in enumerate(_clean_then_flawed(spark, sf), 1):
        staging.append_staging(wh, ticks, batch_id)
        load.incremental_load(wh, only_clean=True)
    return natural_fact(wh)


@query
def full_reload(spark, sf):
    """A full load of all ticks, then one of the clean ones: nothing of the first stays."""
    wh = fresh(spark, "full_reload")
    for batch_id, ticks in enumerate(_clean_then_flawed(spark, sf), 1):
        staging.append_staging(wh, ticks, batch_id)
    load.full_load(wh, minutes=5)
    load.full_load(wh, only_clean=True)
    return natural_fact(wh)


@query
def stream_dedup(spark, sf):
    """Every tick sent twice, kept once."""
    twice = i.ticks_e(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    ticks, state = _tick_stream(spark, twice.repartition(8, "volume"))
    out = scratch_path(spark, "stream_dedup")
    kept = stream.stream_dedup(ticks, "60 days")
    writer = kept.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
    writer.format("parquet").start(out).awaitTermination()
    return spark.read.schema(ticks.schema).parquet(out)


@query
def stream_load(spark, sf):
    """Landed text through staging into facts, micro-batch by micro-batch."""
    wh = fresh(spark, "stream_load")
    rows = i.lineage_e(i.landing_e(spark, sf)).drop("copy", "event_id")
    landing, state = _tick_stream(spark, rows.repartition(8, "date", "symbol"))
    stream.stream_load(wh, landing, state, every=None).awaitTermination()
    return natural_fact(wh)


# --- checks --------------------------------------------------------------------------------------


@query
def check_unique(spark, sf):
    raw, bars = i.raw_ticks_l(spark, sf), bars_l(spark, sf)
    first = checks.check_unique(raw, list(v.TICK_KEY), "tick key")
    return first.unionByName(checks.check_unique(bars, ["symbol", "interval_start"], "bar key")).unionByName(
        checks.check_unique(i.profiles(spark, sf), ["symbol"], "profile symbol")
    )


@query
def check_bounds(spark, sf):
    rules = {
        "open present": checks.not_null("open_price"),
        "volume present": checks.not_null("volume"),
        "symbol length": checks.max_length("ticker_symbol", 5),
        "close below 150": checks.magnitude("close_price", 150),
        "clean": v.clean_flag(),
    }
    return checks.check_bounds(typed_e(spark, sf), rules)


@query
def check_fk(spark, sf):
    """Each fact key against its dimension, and instruments against the companies only."""
    wh = loaded(spark, sf, "L")
    fact = wh.read("fact_15min_stock_price")
    pairs = [
        ("fk_date_id", "dim_date", "sk_date_id"), ("fk_instrument_id", "dim_instrument", "sk_instrument_id"),
        ("fk_company_id", "dim_company", "sk_company_id"), ("fk_exchange_id", "dim_exchange", "sk_exchange_id"),
        ("fk_status_id", "dim_trade_status", "sk_status_id"), ("fk_audit_id", "dim_meta_audit_log", "sk_audit_id"),
    ]
    symbols = marts.fact_instrument_join(fact, wh.read("dim_instrument"))
    report = checks.check_fk(symbols, "symbol", wh.read("stg_companies"), "symbol", "symbol has a company")
    for fk, dim, key in pairs:
        report = report.unionByName(checks.check_fk(fact, fk, wh.read(dim), key, fk))
    return report


@named("bar_days")
def bar_days_l(spark, sf):
    return bar_days(bars_l(spark, sf)).drop("yyyymm")

