"""Run records: the audit log and the per-job control row."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.operators.dims import highest
from tickmart.sources.tables import Warehouse

# Names of the load in the control table and in the audit log.
JOB, SOURCE_SYSTEM = "agg_15min_job", "DW_UPSERT"


@dataclass
class Run:
    audit_id: int
    started: dt.datetime


def start_run(wh: Warehouse, now: dt.datetime | None = None) -> Run:
    return Run(highest(wh.read("dim_meta_audit_log"), "sk_audit_id") + 1, now or dt.datetime.now())


def note_run(wh: Warehouse, run: Run, status: str, raw: int = 0, rejected: int = 0) -> None:
    """A record of the run: one when the facts begin to be built, ``started`` with the bars that there
    are, and one when it ends, whichever way it ends."""
    ended = None if status == "started" else dt.datetime.now()
    record = wh.spark.range(1).select(
        F.lit(run.audit_id).cast("bigint").alias("sk_audit_id"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(raw).cast("bigint").alias("row_count_raw"),
        F.lit(rejected).cast("bigint").alias("row_count_rejected"),
        F.lit(run.started.isoformat(" ")).cast("timestamp_ntz").alias("execution_start_ts"),
        F.lit(ended and ended.isoformat(" ")).cast("timestamp_ntz").alias("execution_end_ts"),
        F.lit((ended - run.started).total_seconds() if ended else 0).cast("decimal(12,2)").alias("execution_time"),
        F.lit(status).alias("status"),
    )
    wh.append(record, "dim_meta_audit_log")


def last_status(wh: Warehouse) -> str | None:
    """Of the last run its last record."""
    newest = F.struct("sk_audit_id", F.col("execution_end_ts").isNotNull())
    return wh.read("dim_meta_audit_log").agg(F.max_by("status", newest)).first()[0]


def runs(wh: Warehouse) -> DataFrame:
    """One row per run: its last record."""
    log = wh.read("dim_meta_audit_log")
    last = F.max_by(F.struct(*log.columns), F.col("execution_end_ts").isNotNull()).alias("r")
    return log.groupBy(F.col("sk_audit_id").alias("_id")).agg(last).select("r.*")


def last_batch(wh: Warehouse, job: str = JOB) -> int | None:
    row = wh.read("elt_control").where(F.col("job_name") == job).select("last_batch_id").first()
    return row[0] if row else None


def settings(wh: Warehouse, job: str = JOB) -> str | None:
    row = wh.read("elt_control").where(F.col("job_name") == job).select("settings").first()
    return row[0] if row else None


def set_control(wh: Warehouse, status: str, last_processed: dt.datetime | None, batch_id: int | None, job: str = JOB, how: str | None = None) -> None:
    """Insert the job's control row the first time, update it later. What is None stays as it was;
    ``how`` are the settings of the load."""
    control = wh.read("elt_control")
    known = control.where(F.col("job_name") == job).first()
    if known is not None:
        last_processed = last_processed or known["last_processed"]
        batch_id = known["last_batch_id"] if batch_id is None else batch_id
        how = how or known["settings"]
    row_id = known["id"] if known is not None else highest(control, "id") + 1
    mark = last_processed.isoformat(" ") if last_processed else None
    row = wh.spark.range(1).select(
        F.lit(row_id).cast("bigint").alias("id"),
        F.lit(mark).cast("timestamp_ntz").alias("last_processed"),
        F.lit(batch_id).cast("bigint").alias("last_batch_id"),
        F.localtimestamp().alias("last_run_ts"),
        F.lit(status).alias("status"),
        F.lit(how).cast("string").alias("settings"),
        F.lit(job).alias("job_name"),
    )
    wh.replace(row, "elt_control")


def clear_bars(wh: Warehouse) -> bool:
    """Empty the bar table if the last load completed; otherwise keep it for review.

    Incremental loads rebuild the bars they need from staging, so clearing is safe.
    """
    if last_status(wh) != "completed":
        return False
    wh.reset("agg_15min_raw")
    return True
