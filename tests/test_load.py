"""Loads: incremental equals full for any arrival order, reruns change nothing."""

import datetime as dt
import pathlib
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tickmart.operators import checks, marts
from tickmart.plans import control, load, staging
from tickmart.registry.queries import natural_fact
from tickmart.session import scratch_root
from tickmart.sources import prices
from tickmart.sources.tables import Warehouse

LANDING = (
    "symbol string, date string, open string, high string, low string, close string, volume string, "
    "_source_name string, _source_filename string, _loaded_at timestamp_ntz"
)


def tick(symbol, when, price, volume=1, loaded=1):
    return (symbol, when, str(price), str(price), str(price), str(price), str(volume), "CSV Import",
            f"{symbol}.csv", dt.datetime(2024, 6, loaded))


def stage(wh, rows, batch_id):
    staging.stage_batch(wh, wh.spark.createDataFrame(rows, LANDING), batch_id)


def facts(wh):
    return sorted(natural_fact(wh).collect())


def bars(wh):
    return sorted(wh.read("agg_15min_raw").collect())


def days(wh):
    return sorted(wh.read("bar_days").collect())


@pytest.fixture
def warehouse(spark, tmp_path):
    made = iter(range(100))
    return lambda **options: Warehouse(spark, str(tmp_path / f"wh{next(made)}"), **options)


def check_same(one, other):
    assert bars(one) == bars(other)
    assert days(one) == days(other)
    assert facts(one) == facts(other)


def full(wh, rows, **options):
    stage(wh, rows, 1)
    load.full_load(wh, **options)
    return wh


def random_ticks(rng, n):
    found = {}
    for _ in range(n):
        when = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 4, 29, 31, 75]), minutes=rng.randrange(570, 700, 3))
        symbol = rng.choice("AAAAB")
        found[symbol, when] = tick(symbol, str(when), rng.randrange(1, 50), rng.randrange(0, 4))
    return list(found.values())


@pytest.mark.parametrize("seed, unit, batches", [(1, "month", 3), (2, "day", 2)])
def test_incremental_equals_full_for_any_arrival_order(warehouse, seed, unit, batches):
    rng = random.Random(seed)
    rows = random_ticks(rng, 160)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(1, len(rows)), batches - 1))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    wh = warehouse(staging_unit=unit)
    for batch_id, part in enumerate(parts, 1):
        stage(wh, part, batch_id)
        assert load.incremental_load(wh)
    check_same(wh, full(warehouse(), rows))


def test_late_corrected_and_repeated_ticks(warehouse):
    first = [tick("A", "2024-01-02 09:31", 10, 5), tick("A", "2024-01-02 09:50", 12, 5), tick("A", "2024-01-05 09:30", 20, 1)]
    late = [
        tick("A", "2024-01-02 09:45", 11, 2, loaded=2),  # on a bar's start, before a tick already loaded
        tick("B", "2023-12-29 10:00", 7, 1, loaded=2),  # a symbol that comes late
        tick("A", "2024-01-05 09:30", 21, 1, loaded=2),  # a correction
        tick("A", "2024-01-04 15:00", 15, 1, loaded=2),  # a day before the next known one
    ]
    wh = warehouse()
    stage(wh, first, 1)
    load.incremental_load(wh)
    stage(wh, late, 2)
    load.incremental_load(wh)
    check_same(wh, full(warehouse(), first + late))
    by_key = {(r.symbol, r.fk_date_id): r for r in natural_fact(wh).collect()}
    assert by_key["A", 20240105093000].previous_close == D(15)
    assert by_key["A", 20240104150000].previous_close == D(12)
    assert by_key["A", 20240105093000].close_price == D(21)

    # staging a batch again, and loading with nothing new, change nothing
    kept = facts(wh)
    stage(wh, late, 2)
    assert not load.incremental_load(wh)
    assert staging.read_staging(wh).count() == 6
    # nor do clearing the bars, compacting staging, or loading everything again
    assert control.clear_bars(wh)
    assert staging.compact_staging(wh, 2) == 1
    assert staging.compact_staging(wh, 2) == 0
    assert wh.read("stg_stock_price").count() == 6
    load.full_load(wh)
    assert facts(wh) == kept
    # and a load after compaction still sees all ticks of the day it touches
    third = [tick("A", "2024-01-02 09:32", 30, 1, loaded=3)]
    stage(wh, third, 3)
    load.incremental_load(wh)
    check_same(wh, full(warehouse(), first + late + third))


def test_every_key_resolves_and_volume_is_kept(warehouse):
    rows = random_ticks(random.Random(3), 120)
    wh = full(warehouse(), rows)
    fact = wh.read("fact_15min_stock_price")
    for fk, dim, key in (
        ("fk_date_id", "dim_date", "sk_date_id"), ("fk_instrument_id", "dim_instrument", "sk_instrument_id"),
        ("fk_status_id", "dim_trade_status", "sk_status_id"), ("fk_audit_id", "dim_meta_audit_log", "sk_audit_id"),
    ):
        assert checks.check_fk(fact, fk, wh.read(dim), key, fk).first().violations == 0
        assert fact.where(F.col(fk).isNull()).count() == 0
    assert fact.agg(F.sum("volume")).first()[0] == sum(int(r[6]) for r in rows)
    assert checks.check_unique(fact, ["fk_date_id", "fk_instrument_id"], "grain").first().violations == 0


def test_empty_batch_and_control(warehouse):
    wh = warehouse()
    assert not load.incremental_load(wh)
    assert control.last_status(wh) is None and control.last_batch(wh) is None
    assert not control.clear_bars(wh)
    stage(wh, [tick("A", "2024-01-02 09:30", 1), tick("A", "x", 1), tick("A", "2024-01-02 09:31", "y")], 4)
    load.incremental_load(wh)
    assert control.last_status(wh) == "completed" and control.last_batch(wh) == 4
    row = wh.read("elt_control").first()
    assert (row.id, row.last_processed, row.status) == (1, dt.datetime(2024, 1, 2, 9, 30), "completed")
    log = wh.read("dim_meta_audit_log").orderBy(F.col("execution_end_ts").isNotNull()).collect()
    assert [(r.sk_audit_id, r.row_count_raw, r.row_count_rejected, r.status) for r in log] == [(1, 1, 0, "started"), (1, 1, 2, "completed")]
    assert [tuple(r) for r in control.runs(wh).select("sk_audit_id", "status").collect()] == [(1, "completed")]


def test_a_failed_run_is_recorded_and_run_again(warehouse, monkeypatch):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1)], 1)
    with monkeypatch.context() as broken:
        broken.setattr(load, "load_dims", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load.incremental_load(wh)
    assert control.last_status(wh) == "failed" and not control.clear_bars(wh)
    assert wh.read("elt_control").first().status == "failed"
    load.incremental_load(wh)
    assert control.last_status(wh) == "completed" and len(facts(wh)) == 1


def test_two_types_for_a_symbol_stop_the_load(warehouse):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1)], 1)
    other = wh.read("stg_stock_price").withColumns({"symbol_type": F.lit("bond"), "trade_date": F.expr("trade_date + interval 1 hour")})
    staging.append_staging(wh, other, 2)
    with pytest.raises(ValueError, match="more than one type"):
        load.full_load(wh)


def test_spark_keeps_wall_clock_marts(warehouse):
    wh = full(warehouse(), [tick("A", "2024-01-31 23:59", 10, 1), tick("A", "2024-02-01 00:00", 20, 1)])
    january = [(dt.date(2024, 1, 1), dt.date(2024, 2, 1))]
    for got in (
        marts.vol_avg_staging(staging.read_staging(wh), january),
        marts.vol_avg_bars(wh.read("agg_15min_raw"), january),
        marts.vol_avg_key_range(marts.fact_instrument_join(wh.read("fact_15min_stock_price"), wh.read("dim_instrument")), january),
    ):
        # the end of a range counts
        assert [tuple(r) for r in got.collect()] == [("A", 2, 15.0)]
    star = marts.star_join(wh.read("fact_15min_stock_price"), wh.read("dim_date"), wh.read("dim_instrument"))
    assert [tuple(r) for r in marts.vol_avg_dim_filter(star, "January", [2024]).collect()] == [("A", 1, 10.0)]


# --- retries, removals, settings -------------------------------------------------------------------


def land(wh, rows):
    return prices.append_landing(wh, wh.spark.createDataFrame(rows, LANDING))


def test_a_batch_that_broke_off_is_staged_again_without_what_landed_since(warehouse, monkeypatch):
    wh = warehouse()
    land(wh, [tick("A", "2024-01-02 09:30", 1), tick("A", "x", 1)])
    with monkeypatch.context() as broken:
        broken.setattr(staging, "set_control", lambda *a: None if a[1] == "started" else 1 / 0)
        broken.setattr(staging, "batch_landing", lambda wh, n, f=staging.batch_landing: f(wh, n))
        with pytest.raises(ZeroDivisionError):
            control.set_control(wh, "started", None, 1, staging.STAGE_JOB)
            staging.stage_new(wh)
    land(wh, [tick("A", "2024-02-02 09:30", 2)])  # another month
    assert staging.stage_new(wh) == 1
    assert staging.stage_new(wh) == 2
    assert staging.stage_new(wh) is None
    load.incremental_load(wh)
    assert [r.close_price for r in sorted(natural_fact(wh).collect(), key=lambda r: r.fk_date_id)] == [D(1), D(2)]
    assert wh.read("rejected_prices").count() == 1


@pytest.mark.parametrize("first_load", [load.incremental_load, load.full_load])
def test_a_load_between_the_break_off_and_the_retry_loses_nothing(warehouse, monkeypatch, first_load):
    wh = warehouse()
    rows = [tick("A", "2024-01-02 09:30", 1), tick("A", "2024-01-03 09:30", 2), tick("B", "2024-01-03 09:30", 2), tick("A", "2024-01-03 09:30", 5, loaded=2)]
    land(wh, rows[:1])
    staging.stage_new(wh)
    load.incremental_load(wh)
    land(wh, rows[1:])
    with monkeypatch.context() as broken:

        def append(self, df, name, f=Warehouse.append):
            f(self, df.where("ticker_symbol = 'A'") if name == "stg_stock_price" else df, name)
            if name == "stg_stock_price":
                raise OSError

        broken.setattr(Warehouse, "append", append)
        with pytest.raises(OSError):
            staging.stage_new(wh)
    first_load(wh)
    assert len(facts(wh)) == 1 and control.last_batch(wh) == 1
    assert staging.stage_new(wh) == 2
    assert load.incremental_load(wh) and control.last_batch(wh) == 2
    check_same(wh, full(warehouse(), rows))
    assert not load.incremental_load(wh)


def test_a_loaded_batch_that_breaks_off_when_staged_again(warehouse, monkeypatch):
    wh = warehouse()
    rows = [tick("A", "2024-01-02 09:30", 1), tick("B", "2024-01-02 09:30", 2)]
    stage(wh, rows, 1)
    load.incremental_load(wh)
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "upsert", lambda self, *a, f=Warehouse.upsert, **k: (f(self, a[0].limit(1), *a[1:], **k), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            stage(wh, rows, 1)
    assert not load.incremental_load(wh) and len(facts(wh)) == 2
    load.full_load(wh)
    stage(wh, rows, 1)
    assert load.incremental_load(wh)
    check_same(wh, full(warehouse(), rows))


def test_batches_do_not_wait_unnoticed_for_one_that_broke_off(warehouse):
    wh = warehouse()
    with pytest.raises(ZeroDivisionError), staging.attempt(wh, 1):
        staging.log_parts(wh, 1, [dt.date(2024, 1, 1)])
        1 / 0
    stage(wh, [tick("A", "2024-01-02 09:30", 1)], 2)
    for run in (load.incremental_load, load.full_load):
        with pytest.raises(RuntimeError, match="stage batch 1 again"):
            run(wh)
    stage(wh, [tick("A", "2024-01-03 09:30", 1)], 1)
    assert load.incremental_load(wh) and len(facts(wh)) == 2


def test_a_batch_staged_again_may_write_other_partitions(warehouse):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1), tick("A", "2024-03-02 09:30", 1)], 1)
    stage(wh, [tick("A", "2024-02-02 09:30", 2), tick("A", "2024-01-02 09:30", 3)], 1)
    load.incremental_load(wh)
    assert sorted((r.fk_date_id, r.close_price) for r in natural_fact(wh).collect()) == [(20240102093000, D(3)), (20240202093000, D(2))]


def test_clocks_do_not_decide_what_is_staged(warehouse):
    wh = warehouse()
    land(wh, [tick("A", "2024-01-02 09:30", 1, loaded=9)])
    assert staging.stage_new(wh) == 1
    land(wh, [tick("A", "2024-01-02 09:45", 2, loaded=3)])  # an older stamp
    assert staging.stage_new(wh) == 2
    # one that broke off before it was complete is not staged
    prices.append_landing(wh, wh.spark.createDataFrame([tick("A", "2024-01-02 10:00", 3)], LANDING), complete=False)
    assert staging.stage_new(wh) is None
    load.incremental_load(wh)
    assert len(facts(wh)) == 2


@pytest.mark.parametrize("only_clean", [True, False])
def test_incremental_equals_full_with_corrections_and_removals(warehouse, only_clean):
    rng = random.Random(only_clean)
    batches = []
    for n in range(2):
        rows = random_ticks(rng, 60)
        # negative prices are not clean: with only_clean such a correction takes a tick away
        batches.append([(*r[:5], f"-{r[5]}" if rng.random() < 0.4 else r[5], r[6], *r[7:9], dt.datetime(2024, 6, n + 1)) for r in rows])
    wh = warehouse()
    for batch_id, rows in enumerate(batches, 1):
        stage(wh, rows, batch_id)
        load.incremental_load(wh, only_clean=only_clean)
    check_same(wh, full(warehouse(), [r for rows in batches for r in rows], only_clean=only_clean))


def test_the_day_after_a_vanished_one_gets_an_earlier_close(warehouse):
    rows = [tick("A", "2024-01-30 09:30", 1), tick("A", "2024-01-31 09:30", 2), tick("A", "2024-02-01 09:30", 3)]
    wh = warehouse()
    stage(wh, rows, 1)
    load.incremental_load(wh, only_clean=True)
    stage(wh, [tick("A", "2024-01-31 09:30", -2, loaded=2)], 2)
    load.incremental_load(wh, only_clean=True)
    found = {r.fk_date_id: r.previous_close for r in natural_fact(wh).collect()}
    assert found == {20240130093000: None, 20240201093000: D(1)}
    stage(wh, [tick("A", "2024-02-01 09:30", -3, loaded=2)], 3)  # the only one of its month
    load.incremental_load(wh, only_clean=True)
    assert [r.fk_date_id for r in natural_fact(wh).collect()] == [20240130093000] and len(bars(wh)) == len(days(wh)) == 1


def test_a_full_load_leaves_nothing_of_the_one_before(warehouse):
    wh = full(warehouse(), [tick("A", "2024-01-31 09:30", -1), tick("A", "2024-02-01 09:30", 3)])
    assert len(facts(wh)) == 2
    load.full_load(wh, only_clean=True)
    assert len(facts(wh)) == len(bars(wh)) == len(days(wh)) == 1


def test_widths_do_not_mix(warehouse):
    wh = full(warehouse(), [tick("A", "2024-01-31 09:40", 1)], minutes=5)
    stage(wh, [tick("A", "2024-01-31 09:50", 1)], 2)
    for other in ({}, {"minutes": 5, "only_clean": True}):
        with pytest.raises(ValueError, match="5min"):
            load.incremental_load(wh, **other)
    assert load.incremental_load(wh, minutes=5)
    load.full_load(wh)
    assert {r.granularity for r in bars(wh)} == {"15min"}


def test_extreme_prices_lose_nothing(warehouse):
    wh = full(warehouse(), [tick("A", "2024-01-01 09:30", "0.000001"), tick("A", "2024-01-02 09:30", "999999999999")])
    last = max(natural_fact(wh).collect(), key=lambda r: r.fk_date_id)
    assert last.price_change == D("999999999998.999999") and last.price_change_pct == D("99999999999899999900.000")


def test_facts_that_break_constraints_stop_the_load(warehouse, monkeypatch):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1)], 1)
    monkeypatch.setattr(load, "enrich", lambda *a, f=load.enrich: f(*a).unionByName(f(*a)))
    with pytest.raises(ValueError, match="one fact per time and instrument: 1"):
        load.incremental_load(wh)
    assert control.last_status(wh) == "failed" and wh.read("fact_15min_stock_price").count() == 0


@pytest.mark.parametrize(
    "name, change, rule",
    [
        ("symbol_keys", lambda keys: keys.withColumn("fk_instrument_id", F.lit(1).cast("bigint")), "one symbol per instrument: 1"),
        ("symbol_keys", lambda keys: keys.withColumn("fk_company_id", F.lit(77).cast("bigint")), "known company: 2"),
        ("symbol_keys", lambda keys: keys.withColumn("fk_exchange_id", F.lit(77).cast("bigint")), "known exchange: 2"),
        ("symbol_keys", lambda keys: keys.withColumn("fk_instrument_id", F.col("fk_instrument_id") + 5), "known instrument: 2"),
        ("symbol_keys", lambda keys: keys.where("symbol = 'A'"), "fk_instrument_id is there: 1"),
        ("fact_rows", lambda facts: facts.withColumn("fk_status_id", F.lit(None).cast("bigint")), "fk_status_id is there: 3"),
        ("with_flags", lambda bars: bars.withColumn("_known_time", F.expr("hour(interval_start) = 9")), "known time: 1"),
    ],
)
def test_every_rule_of_the_facts_stops_the_load(warehouse, monkeypatch, name, change, rule):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1), tick("A", "2024-01-02 10:00", 1), tick("B", "2024-01-02 09:30", 1)], 1)
    monkeypatch.setattr(load, name, lambda *a, f=getattr(load, name): change(f(*a)))
    with pytest.raises(ValueError, match=rule):
        load.incremental_load(wh)
    assert control.last_status(wh) == "failed" and wh.read("fact_15min_stock_price").count() == 0


def test_times_outside_the_calendar_stop_the_load(warehouse, monkeypatch):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1), tick("A", "2024-01-02 10:00", 1)], 1)
    monkeypatch.setattr(load.dims, "date_rows", lambda bars, f=load.dims.date_rows: f(bars).where("hour = 9"))
    with pytest.raises(ValueError, match="known time: 1"):
        load.full_load(wh)


def test_bars_without_a_time_zone_stop_the_load(warehouse, monkeypatch):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1)], 1)
    nameless = lambda *a, f=load.to_bars: f(*a).withColumn("timezone", F.lit(None).cast("string"))
    monkeypatch.setattr(load, "to_bars", nameless)
    with pytest.raises(ValueError, match="1 bars lack"):
        load.incremental_load(wh)


def test_values_wider_than_the_design_are_loaded_and_logged(warehouse):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-01 09:30", "0.001"), tick("A", "2024-01-02 09:30", "99"), tick("LONGERTHANTEN", "2024-01-02 09:30", "1")], 1)
    load.incremental_load(wh)
    stage(wh, [tick("A", "2024-01-03 09:30", "99")], 2)
    load.incremental_load(wh)
    assert wh.read("fact_15min_stock_price").count() == 4
    assert sorted(tuple(r) for r in wh.read("load_checks").collect()) == [
        (1, "dim_instrument.symbol of 10 characters at most", 1),
        (1, "price_change_pct of 4 digits before the point at most", 1),
    ]


def test_checking_facts_neither_shuffles_nor_reads_them_again(warehouse, monkeypatch):
    wh = warehouse()
    stage(wh, [tick("A", "2024-01-02 09:30", 1)], 1)
    load.full_load(wh)
    plans = []
    keep = lambda df, name, f=load.materialize: (plans.append((name, df)), f(df, name))[1]
    monkeypatch.setattr(load, "materialize", keep)
    read = []
    monkeypatch.setattr(checks, "check_fk", lambda df, *a, f=checks.check_fk: (read.append(df.columns), f(df, *a))[1])
    bars = wh.read("agg_15min_raw").drop("yyyymm")
    links = load.day_links(wh.read("bar_days"))
    load.checked_facts(wh, load.enrich(bars, links), 1)
    checked = dict(plans)["facts"]._jdf.queryExecution().executedPlan().toString()
    plain = load.fact_of(wh, load.enrich(bars, links), 1)._jdf.queryExecution().executedPlan().toString()
    # the calendar's days are put together by one exchange; nothing else is new
    assert "CollectMetrics" in checked and checked.count("Exchange hashpartitioning(symbol") == plain.count("Exchange hashpartitioning(symbol")
    assert checked.count("Scan parquet") == plain.count("Scan parquet") + 1
    assert read and all("close_price" not in columns for columns in read)


def test_runs_leave_no_scratch_and_few_log_files(warehouse, tmp_path, spark):
    wh = warehouse()
    root = pathlib.Path(scratch_root(spark).removeprefix("file:"))
    before = len(list(root.glob("tickmart/run-*")))
    for n in range(1, 4):
        stage(wh, [tick("A", f"2024-01-0{n} 09:30", 1)], n)
    load.incremental_load(wh)
    assert len(list(root.glob("tickmart/run-*"))) == before
    rows = sorted(wh.read("staging_log").collect())
    wh.compact_log("staging_log", most_files=2)
    assert len(wh.read("staging_log").inputFiles()) == 1 and sorted(wh.read("staging_log").collect()) == rows
    assert len(list(pathlib.Path(wh.path("rejected_prices")).glob("load_date=*"))) <= 1


def size_of(folder):
    return sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*.parquet"))


MERGED = ("agg_15min_raw", "bar_days", "fact_15min_stock_price")


def test_a_small_batch_writes_little_into_a_large_month(warehouse):
    """Five minutes of ticks, after a month of them: what is written follows the batch, not the month."""
    month = [
        tick(symbol, str(dt.datetime(2024, 1, day, 9, 30) + dt.timedelta(minutes=15 * n)), 10 + n % 7 + day / 10, n)
        for symbol in ("A", "B", "C", "D", "E", "F", "G", "H") for day in range(2, 30) for n in range(26)
    ]
    late = [tick("A", "2024-01-30 09:33", 11, loaded=2)]
    wh = full(warehouse(), month)
    files = {n: set(pathlib.Path(wh.path(n)).rglob("*.parquet")) for n in MERGED}
    before = {n: size_of(wh.path(n)) for n in MERGED}
    stage(wh, late, 2)
    load.incremental_load(wh)
    for name in MERGED:
        assert set(pathlib.Path(wh.path(name)).rglob("*.parquet")) == files[name]
        written = size_of(wh.path(name) + "__changes")
        assert 0 < written and (written < before[name] / 4 or name == "bar_days")
    check_same(wh, full(warehouse(), month + late))


def test_changes_settle_without_a_trace(warehouse, monkeypatch):
    """Months rewritten early, late or never, and rewrites that break off, give the same tables."""
    rng = random.Random(5)
    rows = random_ticks(rng, 120)
    rng.shuffle(rows)
    wh = warehouse(most_changes=1)
    for batch_id in range(4):
        stage(wh, rows[batch_id::4], batch_id + 1)
        load.incremental_load(wh)
        if batch_id == 2:
            with monkeypatch.context() as broken:
                broken.setattr(Warehouse, "_settled", lambda *a: 1 / 0)
                for name in MERGED:
                    if wh.live_changes(name):
                        with pytest.raises(ZeroDivisionError):
                            wh.settle(name)
    other = full(warehouse(), rows)
    check_same(wh, other)
    for name in MERGED:
        wh.settle(name)
        assert not wh.live_changes(name) and size_of(wh.path(name) + "__changes") == 0
    check_same(wh, other)


def test_changes_count_together_or_not_at_all(warehouse, monkeypatch):
    first, late = [tick("A", "2024-01-02 09:31", 10), tick("A", "2024-02-05 09:30", 20)], [tick("A", "2024-02-05 09:30", 21, loaded=2), tick("A", "2024-03-01 10:00", 5, loaded=2)]
    wh = full(warehouse(), first)
    before = bars(wh), days(wh), facts(wh)
    stage(wh, late, 2)
    with monkeypatch.context() as broken, pytest.raises(ZeroDivisionError):
        broken.setattr(load.Changes, "commit", lambda self: 1 / 0)
        load.incremental_load(wh)
    assert before == (bars(wh), days(wh), facts(wh))
    assert control.last_status(wh) == "failed"
    load.incremental_load(wh)
    check_same(wh, full(warehouse(), first + late))
    # a full load, an upsert and clearing take changes along
    assert any(wh.live_changes(n) for n in MERGED)
    load.full_load(wh)
    check_same(wh, full(warehouse(), first + late))
    assert not any(wh.live_changes(n) for n in MERGED)


def test_months_without_changes_are_a_plain_scan(warehouse):
    first, late = [tick("A", "2024-01-02 09:31", 10), tick("A", "2024-02-05 09:30", 20)], [tick("A", "2024-02-05 09:45", 21, loaded=2)]
    wh = full(warehouse(), first)
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "Join" not in plan(wh.read("agg_15min_raw"))
    stage(wh, late, 2)
    load.incremental_load(wh)
    assert set(wh.live_changes("agg_15min_raw")) == {202402}
    january = wh.read("agg_15min_raw").where("yyyymm = 202401")
    assert [r["yyyymm"] for r in january.collect()] == [202401]
    assert wh.read("agg_15min_raw").count() == 3
