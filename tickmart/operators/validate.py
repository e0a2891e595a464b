"""Typing, quality flags and deduplication of landed prices and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.functions import text
from tickmart.operators.joins import spread_join

PRICES = ("open", "high", "low", "close")
TICK_KEY = ("ticker_symbol", "trade_date")
# which of several rows for one key counts: the latest load, then the larger values
PRECEDENCE = (
    "_loaded_at", "open_price", "high_price", "low_price", "close_price", "volume", "_audit_hash",
    "_source_name", "_source_filename",
)


def _parsed(landing: DataFrame) -> DataFrame:
    """``landing`` with its texts read, each once: _at, _open, ..., _volume, and reject_reason.

    ``reject_reason`` names the fields whose text cannot be read, or is NULL. Blank prices and volumes
    are not rejects (they are missing); a row without a readable date is."""
    read = {f"_{p}": text.to_price(F.col(p)) for p in PRICES} | {"_volume": text.to_volume(F.col("volume"))}
    rows = landing.withColumns({"_at": text.to_trade_date(F.col("date"))} | read)
    unreadable = [F.when(F.col("_at").isNull(), "date")]
    for name in (*PRICES, "volume"):
        unreadable.append(F.when((F.trim(F.col(name)) != "") & F.col(f"_{name}").isNull(), name))
    return rows.withColumn("reject_reason", F.nullif(F.concat_ws(",", *unreadable), F.lit("")))


def type_prices(landing: DataFrame, extra: tuple[str | Column, ...] = ("_source_name", "_source_filename", "_loaded_at")) -> DataFrame:
    """Typed ticks; text that cannot be read becomes NULL and is named in ``reject_reason``."""
    return _parsed(landing).select(
        F.col("symbol").alias("ticker_symbol"),
        F.col("_at").alias("trade_date"),
        F.lit(text.TIMEZONE_LABEL).alias("timezone"),
        *[F.col(f"_{p}").alias(f"{p}_price") for p in PRICES],
        F.col("_volume").alias("volume"),
        text.classify_symbol(F.col("symbol")).alias("symbol_type"),
        text.audit_hash(F.col("symbol"), F.col("date"), F.col("close")).alias("_audit_hash"),
        "reject_reason",
        *extra,
    )


def rejected_prices(landing: DataFrame) -> DataFrame:
    """Landed rows, as they came, with the reason."""
    return _parsed(landing).where("reject_reason is not null").select(*landing.columns, "reject_reason")


def clean_flag() -> Column:
    """All values present, none negative, open and close within [low, high]. Zeros are clean."""
    values = [F.col(f"{p}_price") for p in PRICES] + [F.col("volume")]
    opened, high, low, close, _ = values
    present = F.col("trade_date").isNotNull()
    for value in values:
        present = present & value.isNotNull() & (value >= 0)
    within = (low <= high) & opened.between(low, high) & close.between(low, high)
    return F.coalesce(present & within, F.lit(False))


def dup_flag(ticks: DataFrame, spread_by: list[str]) -> DataFrame:
    """Adds ``_is_duplicate``: another row has the same symbol and time.

    Counts are built map-side, and repeated keys are joined back in a copy for each of SPREAD parts,
    to which a key's rows are dealt by ``spread_by``: so no key's rows meet in one task.
    """
    repeated = ticks.groupBy(*TICK_KEY).agg(F.count("*").alias("_n")).where("_n > 1")
    marked = repeated.select(*TICK_KEY, F.lit(True).alias("_again"))
    flagged = spread_join(ticks, marked, list(TICK_KEY), spread_by)
    return flagged.withColumn("_is_duplicate", F.coalesce("_again", F.lit(False))).drop("_again")


def dedup_prices(ticks: DataFrame, order: tuple[str, ...] = PRECEDENCE, was_duplicate: str | None = None) -> DataFrame:
    """One row per symbol and time, with ``_is_duplicate`` telling whether there were more.

    The survivor is the largest row: by ``order`` first, then by all other columns, so it does not
    depend on file or task order. A maximum is partially aggregated before the shuffle, so any
    number of copies of one tick leaves each map task as a single row.
    """
    rest = [c for c in ticks.columns if c not in (*TICK_KEY, *order, was_duplicate)]
    flag = F.count("*") > 1
    if was_duplicate:
        flag = flag | F.bool_or(was_duplicate)
    # time first: rows are sorted by the key, and times tell them apart sooner than symbols
    best = ticks.groupBy(*reversed(TICK_KEY)).agg(
        F.max(F.struct(*order, *rest)).alias("_best"), flag.alias("_is_duplicate")
    )
    return best.select(*TICK_KEY, "_best.*", "_is_duplicate")


def stage_prices(landing: DataFrame) -> DataFrame:
    """Staged ticks of one landed batch: typed, deduplicated, flagged."""
    return stage_typed(type_prices(landing))


def stage_typed(typed: DataFrame) -> DataFrame:
    staged = dedup_prices(typed.drop("reject_reason").where("trade_date is not null"))
    return staged.withColumn("_is_cleaned", clean_flag())


def latest_profile(profiles: DataFrame) -> DataFrame:
    """The newest profile of each company, typed. Spellings of one symbol are one company."""
    typed = {
        "full_time_employees": text.blank_to_null(F.col("full_time_employees")).try_cast("int"),
        "ipo_date": text.blank_to_null(F.col("ipo_date")).try_cast("date"),
        **{c: F.col(c).try_cast("boolean") for c in ("is_active", "is_etf", "is_fund")},
    }
    columns = [
        "symbol", "company_name", "ceo", "currency", "sector", "industry", "full_time_employees",
        "country", "state", "city", "zip", "address", "exchange", "exchange_full_name", "ipo_date",
        "is_active", "is_etf", "is_fund", "_source_name", "_source_filename",
    ]
    rows = profiles.withColumns(typed).withColumn("_key", text.canonical_symbol(F.col("symbol")))
    newest = F.max(F.struct("_loaded_at", *columns)).alias("_newest")
    return rows.groupBy("_key").agg(newest).select(*[f"_newest.{c}" for c in columns], "_newest._loaded_at")
