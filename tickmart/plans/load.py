"""Loading the warehouse: everything, or the batches that arrived since the last run.

Both write the same tables with the same contents, whatever the order in which ticks arrived.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tickmart.functions.calendar import smart_key, yyyymm
from tickmart.operators import checks, dims
from tickmart.operators.bars import bar_days, bar_range_measures, day_links, to_bars, with_month
from tickmart.operators.enrich import enrich, fact_rows, symbol_keys, with_flags
from tickmart.operators.joins import lookup_join
from tickmart.plans.control import JOB, Run, last_batch, note_run, set_control, settings, start_run
from tickmart.plans.staging import before_batch, compact_logs, compact_staging, first_open_batch, incremental_filter, new_batches, read_staging
from tickmart.schemas import FACT_DIGITS, LENGTHS, TABLES
from tickmart.session import materialize, scratch
from tickmart.sources.deltas import Changes
from tickmart.sources.tables import Warehouse


def load_dims(wh: Warehouse, bars: DataFrame, now: Column) -> dict[str, int]:
    """Bring every dimension up to date with ``bars`` (written) and the staged companies. The
    dimensions do not depend on each other, so their small jobs run side by side. Returns the widths
    that new rows exceed."""
    companies = wh.read("stg_companies")
    with ThreadPoolExecutor() as pool:
        loads = [
            pool.submit(_grow, wh, "dim_date", dims.date_rows(bars), ["yyyymm", "sk_date_id"], None),
            pool.submit(_grow, wh, "dim_instrument", dims.instrument_source(bars, companies), ["symbol"], "sk_instrument_id"),
            pool.submit(_grow, wh, "dim_exchange", dims.exchange_rows(companies), ["exchange_code"], "sk_exchange_id"),
            pool.submit(_grow, wh, "dim_trade_status", dims.trade_status_rows(bars), ["agg_status"], "sk_status_id"),
            pool.submit(_update_companies, wh, companies, now),
        ]
    return {rule: n for load in loads for rule, n in load.result().items()}


def _widths(name: str) -> dict[str, Column]:
    return {f"{name}.{c} of {n} characters at most": checks.max_length(c, n) for c, n in LENGTHS[name].items()}


def _grow(wh: Warehouse, name: str, rows: DataFrame, keys: list[str], id_column: str | None) -> dict[str, int]:
    """Append the rows whose key is new."""
    new = dims.insert_absent(wh.read(name), rows, keys, id_column).persist()
    broken = {}
    if not new.isEmpty():
        watched, seen = checks.watch(new, _widths(name))
        wh.append(watched, name)
        broken = checks.violated(seen)
    new.unpersist()
    return broken


def _update_companies(wh: Warehouse, companies: DataFrame, now: Column) -> dict[str, int]:
    changed = dims.upsert_company(wh.read("dim_company"), dims.company_rows(companies, now))
    watched, seen = checks.watch(changed, _widths("dim_company"))
    wh.upsert(materialize(watched, "dim_company"), "dim_company", ["sk_company_id"])
    return checks.violated(seen)


def _symbol_keys(wh: Warehouse) -> DataFrame:
    keys = symbol_keys(
        wh.read("dim_instrument"), wh.read("dim_company"), wh.read("stg_companies"), wh.read("dim_exchange")
    )
    return materialize(keys, "symbol_keys")


def fact_of(wh: Warehouse, enriched: DataFrame, audit_id: int) -> DataFrame:
    return fact_rows(enriched, _symbol_keys(wh), wh.read("dim_trade_status"), audit_id)


def checked_facts(wh: Warehouse, enriched: DataFrame, audit_id: int) -> tuple[DataFrame, dict[str, int]]:
    """The facts, written aside, and how many exceed the design's widths. Stops if a fact lacks its time,
    instrument or status, if two share time and instrument, or if a key is not in its dimension.

    Every rule is counted while the facts are written. Their instrument, company and exchange are
    those of their symbol, so these keys are looked up once a symbol; the facts are not read for it.
    """
    keys = _symbol_keys(wh)
    flagged = with_flags(enriched, wh.read("dim_date"))
    rows = fact_rows(flagged, keys, wh.read("dim_trade_status"), audit_id, ("_repeated", "_known_time"))
    rules = {f"{c} is there": checks.not_null(c) for c in ("fk_date_id", "fk_instrument_id", "fk_status_id", "yyyymm")}
    rules["one fact per time and instrument"] = ~F.col("_repeated")
    rules["known time"] = F.col("_known_time")
    wide = {f"{c} of {n} digits before the point at most": checks.magnitude(c, 10**n) for c, n in FACT_DIGITS.items()}
    watched, seen = checks.watch(rows, rules | wide)
    facts = materialize(watched.drop("_repeated", "_known_time"), "facts")
    broken = checks.violated(seen)
    _stop_at({rule: n for rule, n in broken.items() if rule in rules} | _broken_keys(wh, keys))
    return facts, {rule: n for rule, n in broken.items() if rule in wide}


def _broken_keys(wh: Warehouse, keys: DataFrame) -> dict[str, int]:
    report = checks.check_unique(keys, ["symbol"], "one key per symbol")
    report = report.unionByName(checks.check_unique(keys, ["fk_instrument_id"], "one symbol per instrument"))
    for kind in ("instrument", "company", "exchange"):
        known = wh.read(f"dim_{kind}")
        report = report.unionByName(checks.check_fk(keys, f"fk_{kind}_id", known, f"sk_{kind}_id", f"known {kind}"))
    return {r["rule"]: r["violations"] for r in report.where("violations > 0").collect()}


def _stop_at(broken: dict[str, int]) -> None:
    if broken:
        raise ValueError("facts break their constraints - " + "; ".join(f"{rule}: {n}" for rule, n in broken.items()))


def _log_checks(wh: Warehouse, run: Run, broken: dict[str, int]) -> None:
    """What the run loaded although it is wider than the design."""
    if broken:
        rows = [(run.audit_id, rule, n) for rule, n in sorted(broken.items())]
        wh.append(wh.spark.createDataFrame(rows, TABLES["load_checks"][0]).coalesce(1), "load_checks")


def _survey(bars: DataFrame) -> Row:
    """What the load has to know about the bars, in one pass: day range, high-water mark, row count.
    Stops if a symbol has two types or zones, which would give two bars for one interval, or if one of
    these is missing."""
    by_symbol = bars.groupBy("symbol").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("symbol_type", "timezone") for f in (F.min, F.max)],
        F.count_if(F.expr("symbol is null or symbol_type is null or timezone is null or interval_start is null")).alias("unnamed"),
        *bar_range_measures(F.localtimestamp()),
    )
    clash = F.when(F.expr("min_symbol_type <> max_symbol_type or min_timezone <> max_timezone"), F.col("symbol"))
    found = by_symbol.agg(
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.max("high_water").alias("high_water"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.min(clash).alias("clash"),
        F.sum("unnamed").alias("unnamed"),
    ).first()
    if found["unnamed"]:
        raise ValueError(f"{found['unnamed']} bars lack their symbol, type, time or time zone")
    if found["clash"] is not None:
        raise ValueError(f"symbol {found['clash']} has more than one type or time zone")
    return found


def _how(minutes: int, only_clean: bool) -> str:
    return f"{minutes}min" + ", clean ticks" * only_clean


def full_load(wh: Warehouse, minutes: int = 15, only_clean: bool = False) -> None:
    """Rebuild bars, dimensions and facts from all staged ticks; nothing of an earlier load stays in
    bars and facts. A batch whose staging broke off is left to an incremental load, once it is staged
    again."""
    with scratch(wh.spark):
        _full_load(wh, minutes, only_clean)
    compact_logs(wh)


def _full_load(wh: Warehouse, minutes: int, only_clean: bool) -> None:
    broken_off = first_open_batch(wh)
    run = start_run(wh)
    set_control(wh, "started", None, None)
    try:
        newest = before_batch(wh.read("staging_log"), broken_off, "batch_id").agg(F.max("batch_id")).first()[0]
        if newest is not None:
            compact_staging(wh, newest)
        wh.overwrite(with_month(to_bars(read_staging(wh, before=broken_off), minutes, only_clean)), "agg_15min_raw")
        bars = wh.read("agg_15min_raw")
        span = _survey(bars)
        note_run(wh, run, "started", span["row_count"])
        wh.overwrite(bar_days(bars), "bar_days")
        wide = load_dims(wh, bars, F.localtimestamp())
        links = day_links(wh.read("bar_days"))
        facts, too_wide = checked_facts(wh, enrich(bars.drop("yyyymm"), links), run.audit_id)
        wh.overwrite(facts, "fact_15min_stock_price")
        _log_checks(wh, run, wide | too_wide)
        note_run(wh, run, "completed", span["row_count"], before_batch(wh.read("rejected_prices"), broken_off).count())
    except Exception:
        note_run(wh, run, "failed")
        set_control(wh, "failed", None, None)
        raise
    if newest is None and broken_off is not None:
        newest = broken_off - 1
    set_control(wh, "completed", span["high_water"], newest, how=_how(minutes, only_clean))


def incremental_load(wh: Warehouse, minutes: int = 15, only_clean: bool = False) -> bool:
    """Load the batches after the mark; False if there are none. A batch whose staging broke off is
    none until it is staged again.

    A tick changes its bar, the VWAP of the day's later bars and the previous close of the next
    bar, which may lie days later. So every touched (symbol, day) is rebuilt from staging, and of
    the symbol's next day the first bar. What a touched day had before goes, whether or not something
    takes its place, so the tables are those of a full load. What changes is written beside the tables
    and counts once all of it is there; a run that failed half-way is simply run again. Bars of another width, or of other ticks, would not mix with those there are.
    """
    with scratch(wh.spark):
        found = _incremental_load(wh, minutes, only_clean)
    compact_logs(wh)
    return found


def _incremental_load(wh: Warehouse, minutes: int, only_clean: bool) -> bool:
    mark, broken_off = last_batch(wh), first_open_batch(wh)
    batch, newest = new_batches(wh, mark, broken_off)
    if newest is None:
        return False
    known, how = settings(wh), _how(minutes, only_clean)
    if known not in (None, how):
        raise ValueError(f"the warehouse holds bars of {known}, not {how}: load in full to change that")
    run = start_run(wh)
    set_control(wh, "started", None, None)
    try:
        touched = batch.select(F.col("ticker_symbol").alias("symbol"), F.to_date("trade_date").alias("trade_day")).distinct()
        touched = materialize(touched, "touched")
        if touched.isEmpty():
            note_run(wh, run, "started")
            note_run(wh, run, "completed", 0, _rejects_after(wh, mark, broken_off))
            set_control(wh, "completed", None, newest, how=how)
            return True
        bars = materialize(_rebuild(wh, touched, minutes, only_clean, broken_off), "bars")
        span = _survey(bars)
        note_run(wh, run, "started", span["row_count"])
        changes = Changes(wh)
        gone = touched.withColumn("yyyymm", yyyymm(F.col("trade_day")))
        changes.put("agg_15min_raw", bars, gone.select("symbol", F.col("trade_day").cast("timestamp_ntz").alias("interval_start"), "yyyymm"))
        changes.put("bar_days", materialize(bar_days(bars), "bar_days"), gone)
        wide = load_dims(wh, bars, F.localtimestamp())

        links = materialize(affected_days(wh.read("bar_days", changes), touched), "links")
        after = links.where("not touched").select("symbol", "trade_day")
        changed = bars
        if not after.isEmpty():
            changed = bars.unionByName(materialize(_rebuild(wh, after, minutes, only_clean, broken_off), "later"))
        enriched = enrich(changed.drop("yyyymm"), links)
        enriched = enriched.join(links.select("symbol", "trade_day", "touched"), ["symbol", "trade_day"])
        enriched = enriched.where("touched or bar_of_day = 1").drop("touched")
        facts, too_wide = checked_facts(wh, enriched, run.audit_id)
        instruments = wh.read("dim_instrument").select("symbol", F.col("sk_instrument_id").alias("fk_instrument_id"))
        # facts for all that the touched days had, and by key for single bars of other days
        days = gone.join(instruments, "symbol").select("fk_instrument_id", smart_key(F.col("trade_day")).alias("fk_date_id"), "yyyymm")
        changes.put("fact_15min_stock_price", facts, days)
        changes.commit()
        _log_checks(wh, run, wide | too_wide)
        note_run(wh, run, "completed", span["row_count"], _rejects_after(wh, mark, broken_off))
    except Exception:
        note_run(wh, run, "failed")
        set_control(wh, "failed", None, None)
        raise
    set_control(wh, "completed", _later(span["high_water"], wh), newest, how=how)
    return True


def _rejects_after(wh: Warehouse, mark: int | None, before: int | None) -> int:
    return before_batch(incremental_filter(wh.read("rejected_prices"), mark), before).count()


def _later(high_water: dt.datetime | None, wh: Warehouse) -> dt.datetime | None:
    known = wh.read("elt_control").where(F.col("job_name") == JOB).agg(F.max("last_processed")).first()[0]
    return max((t for t in (high_water, known) if t is not None), default=None)


def _rebuild(wh: Warehouse, symbol_days: DataFrame, minutes: int, only_clean: bool, before: int | None) -> DataFrame:
    """Whole bars of the given (symbol, day) pairs, from all staged ticks (``before`` a batch) of those days."""
    days = [r[0] for r in symbol_days.select("trade_day").distinct().collect()]
    wanted = symbol_days.withColumnRenamed("symbol", "ticker_symbol")
    ticks = read_staging(wh, days, before).withColumn("trade_day", F.to_date("trade_date"))
    ticks = lookup_join(ticks, wanted, ["ticker_symbol", "trade_day"], "left_semi")
    return with_month(to_bars(ticks, minutes, only_clean))


def affected_days(days: DataFrame, touched: DataFrame) -> DataFrame:
    """day_links of the touched days that have bars, and of each touched day's next one with bars,
    also where the touched day itself has none left."""
    symbols = touched.select("symbol").distinct()
    mine = lookup_join(days, symbols, ["symbol"], "left_semi")
    flags = touched.withColumn("touched", F.lit(True))
    w = Window.partitionBy("symbol").orderBy("trade_day")
    linked = day_links(mine).withColumn("_has_bars", F.lit(True)).join(flags, ["symbol", "trade_day"], "full")
    linked = linked.withColumn("touched", F.coalesce("touched", F.lit(False)))
    after = linked.withColumn("_after", F.lag("touched", 1, False).over(w))
    return after.where("_has_bars and (touched or _after)").drop("_after", "_has_bars")
