"""Landed batches to staging.

Batches are appended; which partitions a batch wrote is kept in a small log, so loads read only
the partitions they need. A key that several batches sent is resolved when read, until the
partition is compacted.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.operators.validate import TICK_KEY, dedup_prices, latest_profile, stage_typed, type_prices
from tickmart.plans.control import set_control
from tickmart.schemas import LINEAGE_COLUMNS, PRICE_TEXT
from tickmart.session import materialize, scratch
from tickmart.sources.tables import Warehouse

STAGE_JOB = "stage_prices_job"
STREAM_JOB = "stream_load_job"


def _part(wh: Warehouse, at: Column) -> Column:
    return F.trunc(at.cast("date"), "month") if wh.staging_unit == "month" else at.cast("date")


def _parts_of_days(wh: Warehouse, days: list[dt.date]) -> list[dt.date]:
    return sorted({d.replace(day=1) if wh.staging_unit == "month" else d for d in days})


def _log(wh: Warehouse, rows: list[tuple[dt.date, int, bool]]) -> None:
    wh.append(wh.spark.createDataFrame(rows, "trade_part date, batch_id bigint, compacted boolean"), "staging_log")


def _attempts(wh: Warehouse, batch_id: int, attempts: list[str], done: bool) -> None:
    rows = [(batch_id, a, done) for a in attempts]
    wh.append(wh.spark.createDataFrame(rows, "batch_id bigint, attempt string, done boolean").coalesce(1), "staging_attempts")


@contextmanager
def attempt(wh: Warehouse, batch_id: int) -> Iterator[None]:
    """Stages a batch; until this ends without an error, the batch is open. Success also closes the
    attempts at the batch that broke off before."""
    _attempts(wh, batch_id, [uuid.uuid4().hex], False)
    yield
    begun = _open_attempts(wh).where(F.col("batch_id") == batch_id)
    _attempts(wh, batch_id, [r["attempt"] for r in begun.collect()], True)


def _open_attempts(wh: Warehouse) -> DataFrame:
    found = wh.read("staging_attempts").groupBy("batch_id", "attempt").agg(F.max("done").alias("done"))
    return found.where("not done").select("batch_id", "attempt")


def first_open_batch(wh: Warehouse) -> int | None:
    """The first batch whose staging broke off. Loads take the batches before it; they stop if there
    are others after it, as these would wait for it unnoticed."""
    found = _open_attempts(wh).agg(F.min("batch_id")).first()[0]
    if found is not None:
        whole = wh.read("staging_log").where(F.col("batch_id") > found).join(_open_attempts(wh), "batch_id", "left_anti")
        after = whole.agg(F.min("batch_id")).first()[0]
        if after is not None:
            raise RuntimeError(f"staging of batch {found} broke off, and batch {after} is after it: stage batch {found} again")
    return found


def before_batch(rows: DataFrame, batch_id: int | None, column: str = "_batch_id") -> DataFrame:
    """Rows of earlier batches; all if None."""
    return rows if batch_id is None else rows.where(F.col(column) < batch_id)


def append_staging(wh: Warehouse, staged: DataFrame, batch_id: int, parts: list[dt.date] | None = None) -> None:
    """Add a batch; a batch that was begun before replaces what it wrote. If this breaks off, loads
    leave the batch alone until it is staged again.

    ``parts`` lists the partitions it may write (computed from ``staged`` if absent). They are
    logged first: a crash then leaves a log row too many, never unlogged ticks.
    """
    with attempt(wh, batch_id):
        _append_staging(wh, staged, batch_id, parts)


def _append_staging(wh: Warehouse, staged: DataFrame, batch_id: int, parts: list[dt.date] | None) -> None:
    rows = staged.withColumns(
        {"trade_part": _part(wh, F.col("trade_date")), "_batch_id": F.lit(batch_id).cast("bigint")}
    )
    if parts is None:
        parts = _list_parts(rows.select("trade_part"))
    begun = log_parts(wh, batch_id, parts)
    if not parts and not begun:
        return
    if not begun:
        wh.append(rows, "stg_stock_price")
        return
    # what the batch wrote before goes, also from partitions in which it has nothing any more
    others = F.col("_batch_id") != batch_id
    wh.upsert(materialize(rows, "staged"), "stg_stock_price", [*TICK_KEY, "_batch_id"], begun, lambda stored: stored.where(others))


def log_parts(wh: Warehouse, batch_id: int, parts: list[dt.date]) -> list[dt.date]:
    """Name the partitions that a batch will write; returns those it named before."""
    begun = [r[0] for r in wh.read("staging_log").where(F.col("batch_id") == batch_id).select("trade_part").distinct().collect()]
    if new := sorted(set(parts) - set(begun)):
        _log(wh, [(part, batch_id, False) for part in new])
    return begun


def _list_parts(parts: DataFrame) -> list[dt.date]:
    """Days or months of the calendar - never rows."""
    return [r[0] for r in parts.distinct().collect()]


def stage_batch(wh: Warehouse, landing: DataFrame, batch_id: int) -> None:
    """Validate a landed batch into staging and set its rejects aside. It is read and typed once."""
    with scratch(wh.spark), attempt(wh, batch_id):
        _stage_batch(wh, landing, batch_id)


def _stage_batch(wh: Warehouse, landing: DataFrame, batch_id: int) -> None:
    # rows are set aside as they came; those that are not leave their texts behind
    landed = F.when(F.col("reject_reason").isNotNull(), F.struct("symbol", *PRICE_TEXT)).alias("_landed")
    typed = materialize(type_prices(landing, extra=(*LINEAGE_COLUMNS, landed)), "typed")
    dates = typed.where("trade_date is not null").select(_part(wh, F.col("trade_date")).alias("trade_part"))
    _append_staging(wh, stage_typed(typed.drop("_landed")), batch_id, _list_parts(dates))

    day = F.coalesce(F.to_date("_loaded_at"), F.lit(dt.date(1970, 1, 1))).alias("load_date")
    rejects = typed.where("reject_reason is not null").select(
        "_landed.*", *LINEAGE_COLUMNS, "reject_reason", F.lit(batch_id).cast("bigint").alias("_batch_id"), day
    )
    mine = F.col("_batch_id") == batch_id
    before = [r[0] for r in wh.read("rejected_prices").where(mine).select("load_date").distinct().collect()]
    if before:
        wh.upsert(rejects, "rejected_prices", ["_batch_id"], before, lambda stored: stored.where(~mine))
    else:
        wh.append(rejects, "rejected_prices")


def stage_new(wh: Warehouse) -> int | None:
    """Stage the complete landings that no batch has yet, as the next batch; its id, or None if there
    are none. If it breaks off, the next call stages the same batch again; what landed since is left
    for the one after."""
    batch_id = begin_batch(wh)
    if batch_id is None:
        return None
    landing = batch_landing(wh, batch_id)
    stage_batch(wh, landing, batch_id)
    set_control(wh, "completed", landing.agg(F.max("_loaded_at")).first()[0], batch_id, STAGE_JOB)
    return batch_id


def begin_batch(wh: Warehouse) -> int | None:
    """The batch that broke off, or else a new one of the landings that no batch has. Which landings
    make up a batch is written down before it is staged, so no clock and no later landing changes it."""
    if wh.read("elt_control").where(F.col("job_name").startswith(STREAM_JOB)).first() is not None:
        raise RuntimeError("landing of this warehouse is staged by a stream")
    known = wh.read("elt_control").where(F.col("job_name") == STAGE_JOB).first()
    broken_off = known is not None and known["status"] == "started"
    batch_id = known["last_batch_id"] + (0 if broken_off else 1) if known is not None else 1
    taken = wh.read("staged_landings")
    if broken_off and not taken.where(F.col("batch_id") == batch_id).isEmpty():
        return batch_id
    new = materialize(wh.read("landing_log").join(taken, ["_landing", "load_date"], "left_anti"), "new_landings")
    if new.isEmpty():
        return None
    set_control(wh, "started", None, batch_id, STAGE_JOB)
    wh.append(new.withColumn("batch_id", F.lit(batch_id).cast("bigint")).coalesce(1), "staged_landings")
    return batch_id


def batch_landing(wh: Warehouse, batch_id: int) -> DataFrame:
    """The landed rows of a batch."""
    # one row per landing and day, not per file or tick
    rows = wh.read("staged_landings").where(F.col("batch_id") == batch_id).select("_landing", "load_date").distinct().collect()
    days, landings = (sorted({r[c] for r in rows}) for c in ("load_date", "_landing"))
    return wh.read("landing_prices").where(F.col("load_date").isin(days) & F.col("_landing").isin(landings))


def stream_base(wh: Warehouse, checkpoint: str) -> int:
    """The batch id a stream counts from: the last one at its first start, remembered with its
    checkpoint so that restarts give a micro-batch the same id."""
    job = f"{STREAM_JOB} {checkpoint}"
    known = wh.read("elt_control").where(F.col("job_name") == job).first()
    if known is not None:
        return known["last_batch_id"]
    base = wh.read("staging_log").agg(F.max("batch_id")).first()[0] or 0
    set_control(wh, "started", None, base, job)
    return base


def mixed_parts(wh: Warehouse, before: int | None = None) -> DataFrame:
    """Partitions more than one batch (of those ``before`` one) wrote since they were last compacted,
    with their last batch."""
    log = before_batch(wh.read("staging_log"), before, "batch_id")
    base = log.where("compacted").groupBy("trade_part").agg(F.max("batch_id").alias("base"))
    live = log.join(base, "trade_part", "left").where("base is null or batch_id >= base")
    ends = live.groupBy("trade_part").agg(F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"))
    return ends.where("first_batch < last_batch").select("trade_part", "last_batch")


def read_staging(wh: Warehouse, days: list[dt.date] | None = None, before: int | None = None) -> DataFrame:
    """Staged ticks (of the batches ``before`` one), one row per symbol and time; the latest load wins.

    A batch holds no repeats, so only partitions that several batches wrote are deduplicated here;
    the rest is a plain scan without a shuffle.
    """
    rows, mixed_in = before_batch(wh.read("stg_stock_price"), before), mixed_parts(wh, before)
    if days is not None:
        parts = _parts_of_days(wh, days)
        rows = rows.where(F.col("trade_part").isin(parts) & F.col("trade_date").cast("date").isin(days))
        first, end = min(days), max(days) + dt.timedelta(days=1)
        span = F.col("trade_date") >= F.lit(first).cast("timestamp_ntz")
        # a range on the stored column, which file statistics can check
        rows = rows.where(span & (F.col("trade_date") < F.lit(end).cast("timestamp_ntz")))
        mixed_in = mixed_in.where(F.col("trade_part").isin(parts))
    mixed = [r["trade_part"] for r in mixed_in.collect()]
    if not mixed:
        return rows
    return rows.where(~F.col("trade_part").isin(mixed)).unionByName(_resolve(rows.where(F.col("trade_part").isin(mixed))))


def _resolve(rows: DataFrame) -> DataFrame:
    return dedup_prices(rows, was_duplicate="_is_duplicate").select(*rows.columns)


def compact_staging(wh: Warehouse, through: int) -> int:
    """Resolve repeats for good in partitions whose last batch is ``through`` (already loaded) or
    older; returns how many were rewritten."""
    todo = mixed_parts(wh).where(F.col("last_batch") <= through).collect()
    if not todo:
        return 0
    parts = [r["trade_part"] for r in todo]
    rows = wh.read("stg_stock_price").where(F.col("trade_part").isin(parts))
    wh.replace(_resolve(rows), "stg_stock_price")
    _log(wh, [(r["trade_part"], r["last_batch"], True) for r in todo])
    return len(parts)


def compact_logs(wh: Warehouse) -> None:
    """Logs of many small files as one file each."""
    for name in ("staging_log", "staging_attempts", "landing_log", "staged_landings", "ingest_log", "dim_meta_audit_log", "load_checks", "delta_log"):
        wh.compact_log(name)


def incremental_filter(staging: DataFrame, last_batch_id: int | None) -> DataFrame:
    """Rows of batches after the mark - by arrival, not by event time, so late ticks count."""
    if last_batch_id is None:
        return staging
    return staging.where(F.col("_batch_id") > last_batch_id)


def new_batches(wh: Warehouse, last_batch_id: int | None, before: int | None = None) -> tuple[DataFrame, int | None]:
    """Staged rows after the mark (and ``before`` a batch), read from the partitions the log names, and
    the newest batch."""
    log = before_batch(wh.read("staging_log").where("not compacted"), before, "batch_id")
    if last_batch_id is not None:
        log = log.where(F.col("batch_id") > last_batch_id)
    rows = log.groupBy("trade_part").agg(F.max("batch_id").alias("newest")).collect()
    staging = wh.read("stg_stock_price").where(F.col("trade_part").isin([r["trade_part"] for r in rows]))
    return before_batch(incremental_filter(staging, last_batch_id), before), max((r["newest"] for r in rows), default=None)


def refresh_companies(wh: Warehouse) -> None:
    wh.replace(latest_profile(wh.read("landing_profiles")), "stg_companies")
