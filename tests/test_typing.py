"""Typing of landed text: its cost a row, and odd texts."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tickmart.functions import text
from tickmart.operators import validate as v
from tickmart.plans import staging
from tickmart.schemas import LINEAGE_COLUMNS, PRICE_TEXT
from tickmart.sources.tables import Warehouse
from tickmart.streaming import stream

LANDED = ("symbol", *PRICE_TEXT)
ROWS = [
    ("A", "2024-01-02 09:30:00", "1", "2", "1", "1.5", "10"),
    ("A", " 2024-01-02 09:31:00 ", "1", "2", "1", "abc", "10"),
    ("B_C", "someday", "1", "2", "1", "1.5", ""),
    ("B_C", "1/2/2024 9:30 am", "1", "", "1", " ", "10.0"),
]


def landed(spark, path):
    rows = spark.createDataFrame(ROWS, ", ".join(f"{c} string" for c in LANDED))
    lineage = {"_source_name": F.lit("CSV Import"), "_source_filename": F.lit("x.csv"), "_loaded_at": F.lit("2024-02-01").cast("timestamp_ntz")}
    rows.withColumns(lineage).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_the_jvm_compiles_typing(spark, tmp_path, capsys):
    """Methods of over 8,000 bytes are interpreted, at several times the cost a row."""
    rows = landed(spark, str(tmp_path / "landed"))
    v.type_prices(rows, extra=(*LINEAGE_COLUMNS, F.struct(*LANDED).alias("_landed"))).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 7000


def test_only_rejects_keep_their_text_while_staged(spark, tmp_path, monkeypatch):
    written = []

    def noting(df, name):
        written.append(materialize(df, name))
        return written[-1]

    materialize = staging.materialize
    monkeypatch.setattr(staging, "materialize", noting)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rows = landed(spark, str(tmp_path / "landed"))
    kept = []
    append = staging._append_staging
    monkeypatch.setattr(staging, "_append_staging", lambda *a: (append(*a), kept.extend(written[0].where("_landed is not null").collect())))
    staging.stage_batch(wh, rows, 1)
    assert sorted(r["reject_reason"] for r in kept) == ["close", "date"]
    rejects = wh.read("rejected_prices").select(*LANDED).collect()
    assert sorted(map(tuple, rejects)) == sorted([ROWS[1], ROWS[2]])
    assert wh.read("stg_stock_price").count() == 3


def test_a_micro_batch_of_one_file_is_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(stream, "stage_batch", lambda wh, rows, batch_id: seen.append((rows.rdd.getNumPartitions(), rows.count())))
    monkeypatch.setattr(stream, "incremental_load", lambda wh, minutes: None)
    rows = landed(spark, str(tmp_path / "landed"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    # these few rows would be brought together again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "landed"))
        stream.stream_load(Warehouse(spark, str(tmp_path / "wh")), source, str(tmp_path / "state"), every=None).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(seen) == 1 and seen[0][0] > 1 and seen[0][1] == len(ROWS)


@pytest.mark.parametrize("value, want", [
    ("1/2/2024T 12:00PM", "2024-01-02 12:00:00"), ("2024-1-2 T 1:02:03.5  pm", "2024-01-02 13:02:03.500000"), ("12/31/2024 12:59 am\n", "2024-12-31 00:59:00"),
    ("1/2/2024 9:30 x", None), ("1/2/2024 9:30 m", None), ("1/2/20245", None), ("2024-1-2 9:30 am pm", None), ("13/1/2024", None),
])
def test_odd_dates(spark, value, want):
    found = spark.createDataFrame([(value,)], "d string").select(text.to_trade_date(F.col("d"))).first()[0]
    assert (found and str(found)) == want


def test_symbols_keep_ascii_letters_and_digits(spark):
    rows = spark.createDataFrame([("i-r_x",), ("é^DJI\n",), ("٣A1",), ("_",), (None,)], "s string")
    found = rows.select(text.canonical_symbol(F.col("s")), text.classify_symbol(F.col("s"))).collect()
    assert [tuple(r) for r in found] == [("irx", "bond"), ("dji", "index"), ("a1", "stock"), ("", "stock"), (None, "stock")]
