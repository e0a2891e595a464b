"""Plans and hot keys: what must hold when tables are large."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tickmart.operators import joins, marts, validate
from tickmart.operators.bars import to_bars
from tickmart.operators.enrich import enrich, running_vwap
from tickmart.registry import inputs, queries
from tickmart.sources.tables import Warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_bars_aggregate_by_hash_before_the_shuffle(spark, sf):
    text = plan(to_bars(inputs.ticks_e(spark, sf)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_dedup_combines_copies_before_the_shuffle(spark, sf):
    text = plan(inputs.ticks_l(spark, sf))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max" in text


def test_no_window_over_a_whole_symbol(spark, sf):
    bars = to_bars(inputs.ticks_e(spark, sf))
    for df in (running_vwap(bars), enrich(bars), marts.moving_average(bars)):
        text = plan(df)
        assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
        # windows by symbol alone run over days
        for keys in re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", text):
            assert "," in keys[0] or "trade_day" in keys[1]
    assert plan(running_vwap(bars)).count("FileScan") == 1


def test_star_queries_prune_months(spark, sf):
    wh = queries.loaded(spark, sf, "L")
    star = queries.star(spark, sf, "L")
    by_dim = marts.vol_avg_dim_filter(star, "March", [1996, 1998])
    # months are skipped by a filter that does not depend on how the calendar is joined
    scans = re.findall(r"FileScan parquet [^\n]*fk_instrument_id[^\n]*", plan(by_dim))
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*yyyymm#\d+ IN \(199603,199803\)", s) for s in scans)
    by_key = marts.vol_avg_key_range(queries.fact_instruments(spark, sf, "L"), queries.MARCH)
    assert re.search(r"PartitionFilters: \[[^\]]*yyyymm", plan(by_key))
    assert "fk_date_id,GreaterThanOrEqual" not in plan(by_key)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(fk_date_id", plan(by_key))
    by_tick = marts.vol_avg_staging(wh.read("stg_stock_price"), queries.MARCH)
    assert re.search(r"PartitionFilters: \[[^\]]*trade_part", plan(by_tick))
    for df in (by_dim, by_key, by_tick):
        assert "open_price" not in plan(df) and "CartesianProduct" not in plan(df)
    months = {int(m) for f in by_key.inputFiles() for m in re.findall(r"yyyymm=(\d+)", f)}
    assert len(months) > 4  # all files are listed; the plan reads four months of them


def test_top_n_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in initial_plan(queries.daily_volatility_top5(spark, sf))


def test_lookup_join_is_the_same_broadcast_or_spread(spark):
    big = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    lookup = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([(7, 70)], "k bigint, v bigint"))
    for how in ("left", "inner", "left_semi"):
        small = joins.lookup_join(big, lookup, ["k"], how)
        spread = joins.spread_join(big, lookup, ["k"], ["n"], how)
        assert sorted(small.collect(), key=str) == sorted(spread.select(*small.columns).collect(), key=str)


def test_flag_of_a_hot_key(spark):
    start = dt.datetime(2024, 1, 1)
    times = [0] * 500 + list(range(1, 200)) + list(range(150, 250))
    rows = [("A", start + dt.timedelta(minutes=m), n) for n, m in enumerate(times)]
    ticks = spark.createDataFrame(rows, "ticker_symbol string, trade_date timestamp_ntz, n int")
    want = {n: times.count(m) > 1 for n, m in enumerate(times)}
    flagged = validate.dup_flag(ticks, ["n"])
    assert {r.n: r._is_duplicate for r in flagged.collect()} == want
    assert flagged.count() == len(rows)


def test_joins_are_left_to_spark(spark, sf):
    """No size is counted while a query is built, and no side is broadcast whatever its size."""
    wh = queries.loaded(spark, sf, "L")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        star = marts.star_join(wh.read("fact_15min_stock_price"), wh.read("dim_date"), wh.read("dim_instrument"))
        by_dim = marts.vol_avg_dim_filter(star, "March", [1996, 1998])
        rows = by_dim.collect()
        final = plan(by_dim)
        assert rows and "BroadcastExchange" not in final and "BroadcastHashJoin" not in final
        read = {int(m) for m in re.findall(r"yyyymm#\d+ IN \((\d+),", final)}
        assert read == {199603}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_come_in_order(spark, sf):
    monthly = [(r.symbol, r.month_number) for r in queries.monthly_ohlcv(spark, sf).collect()]
    assert monthly == sorted(monthly) and len(monthly) > 12
    one = [r.month_number for r in queries.monthly_ohlcv_symbol(spark, sf).collect()]
    assert one == sorted(one)
    change = [r.pct_change for r in queries.daily_pct_change(spark, sf).collect()]
    assert change == sorted(change, reverse=True) and len(change) > 1
    spread = [r.volatility_pct for r in queries.daily_volatility_top5(spark, sf).collect()]
    assert spread == sorted(spread, reverse=True) and len(spread) > 1
    average = [(r.symbol, r.day) for r in queries.sma_50_fact(spark, sf).collect()]
    by_day = sorted(average, key=lambda r: r[1], reverse=True)
    assert average == sorted(by_day, key=lambda r: r[0])


@pytest.mark.parametrize("window, block", [(50, 49), (50, 64), (3, 2), (3, 1000), (1, 5)])
def test_moving_average_across_blocks_and_days(spark, window, block):
    rng = random.Random(window * block)
    rows = []
    for symbol, n in (("HOT", 700), ("B", 20), ("C", 1)):
        at = dt.datetime(2024, 1, 1)
        for _ in range(n):
            at += dt.timedelta(minutes=15 * rng.choice([1, 1, 2, 60]))
            rows.append((symbol, at, rng.choice([None, *range(1, 90)])))
    bars = spark.createDataFrame(rows, "symbol string, interval_start timestamp_ntz, close int")
    bars = bars.withColumn("close", F.col("close").cast("decimal(18,6)"))
    got = {(r.symbol, r.day): r[f"sma_{window}"] for r in marts.moving_average(bars, window, block=block).collect()}
    want = {}
    for symbol in ("HOT", "B", "C"):
        mine = [r for r in rows if r[0] == symbol]
        for i, (_, at, _) in enumerate(mine):
            frame = [c for _, _, c in mine[max(0, i - window + 1) : i + 1] if c is not None]
            want[symbol, at] = pytest.approx(sum(frame) / len(frame), abs=1e-6) if frame else None
    assert got == want


def test_a_block_must_hold_a_frame(spark):
    bars = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), 1)], "symbol string, interval_start timestamp_ntz, close int")
    with pytest.raises(ValueError):
        marts.moving_average(bars, 50, block=10)


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rows = [(202401, 1), (202401, 2), (202402, 3)]
    ddl = "yyyymm int, n_bars bigint"
    days = spark.createDataFrame(rows, ddl).withColumns(
        {"symbol": F.col("n_bars").cast("string"), "trade_day": F.current_date(), "last_close": F.lit(None).cast("decimal(18,6)")}
    )
    wh.replace(days, "bar_days")
    before = {f for f in wh.read("bar_days").inputFiles() if "202402" in f}
    wh.upsert(days.where("symbol = '2'").withColumn("n_bars", F.lit(20).cast("bigint")), "bar_days", ["symbol", "trade_day"])
    assert sorted(r.n_bars for r in wh.read("bar_days").collect()) == [1, 3, 20]
    assert {f for f in wh.read("bar_days").inputFiles() if "202402" in f} == before
