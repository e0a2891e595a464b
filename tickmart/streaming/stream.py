"""Structured Streaming forms of the load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickmart.functions.calendar import cut_minutes, yyyymm
from tickmart.operators.bars import bar_measures
from tickmart.plans.load import incremental_load
from tickmart.plans.staging import compact_staging, stage_batch, stream_base
from tickmart.session import materialize, scratch
from tickmart.sources.deltas import Changes
from tickmart.sources.tables import Warehouse

#: Micro-batches after which partitions that several of them wrote are compacted.
COMPACT_EVERY = 96
TICK = ["ticker_symbol", "symbol_type", "timezone"]


def to_instant(column: str) -> Column:
    """Watermarks need a zoned timestamp: read the wall clock as UTC, whatever the session zone.

    Put together from parts, because Spark subtracts and casts by way of the session zone, which
    bends an hour a year.
    """
    at = F.col(column)
    minutes = F.unix_date(at.cast("date")).cast("bigint") * 1440 + F.hour(at) * 60 + F.minute(at)
    micros = (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")
    return F.timestamp_micros(minutes * 60_000_000 + micros)


def stream_dedup(ticks: DataFrame, watermark: str) -> DataFrame:
    """First arrival of each (symbol, time); copies later than the watermark may pass."""
    stamped = ticks.withColumn("_at", to_instant("trade_date")).withWatermark("_at", watermark)
    return stamped.dropDuplicatesWithinWatermark(["ticker_symbol", "_at"]).drop("_at")


def windowed_bars(ticks: DataFrame, minutes: int, watermark: str) -> DataFrame:
    """OHLCV per bar, with the bar starts of ``time_bucket``. A bar lies within its hour, so the state
    of an hour goes when the watermark passes it. Ticks that arrive later than the watermark are not
    counted: where that can happen use stream_load, which recounts."""
    stamped = ticks.withColumn("_at", to_instant("trade_date")).withWatermark("_at", watermark)
    stamped = stamped.withColumn("interval_start", cut_minutes(F.col("trade_date"), minutes))
    bars = stamped.groupBy(*TICK, F.window("_at", "60 minutes").alias("w"), "interval_start").agg(
        *[c.alias(n) for n, c in bar_measures().items()]
    )
    return bars.withColumnRenamed("ticker_symbol", "symbol").withColumns(
        {"granularity": F.lit(f"{minutes}min"), "yyyymm": yyyymm(F.col("interval_start"))}
    ).drop("w")


def start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str, every: str | None) -> StreamingQuery:
    """Run ``sink`` on each micro-batch: every ``every``, or until the input is used up."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_bars(wh: Warehouse, ticks: DataFrame, checkpoint: str, minutes: int = 15,
                watermark: str = "1 day", every: str | None = "5 minutes") -> StreamingQuery:
    """Continuous bars: changed windows replace their bars, in files of the size of the change. A
    micro-batch that is tried again replaces the same bars again."""

    def sink(changed: DataFrame, _: int) -> None:
        with scratch(wh.spark):
            changes = Changes(wh)
            changes.put("agg_15min_raw", materialize(changed, "stream_bars"))
            changes.commit()

    return start(windowed_bars(ticks, minutes, watermark), sink, checkpoint, "update", every)


def stream_load(wh: Warehouse, landing: DataFrame, checkpoint: str, minutes: int = 15,
                every: str | None = "5 minutes") -> StreamingQuery:
    """Continuous load of landed rows through staging into the star schema, exact for any lateness.

    Enrichment needs row windows, which streams do not offer, so each micro-batch is staged and
    loaded incrementally. A micro-batch keeps its id when retried and then replaces itself. Batches
    staged before the stream's first start keep theirs.
    """
    base = stream_base(wh, checkpoint)

    def sink(landed: DataFrame, epoch: int) -> None:
        # a micro-batch may come in fewer files than there are cores
        stage_batch(wh, landed.hint("rebalance", "symbol", "date"), base + 1 + epoch)
        incremental_load(wh, minutes)
        if epoch % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact_staging(wh, base + 1 + epoch)

    return start(landing, sink, checkpoint, "append", every)
