"""Hand-written rows for each rule; expected values are in the test."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tickmart.functions import measures, text
from tickmart.functions.calendar import calendar_columns, key_month, smart_key, time_bucket
from tickmart.operators import dims, validate
from tickmart.operators.bars import bar_range, to_bars
from tickmart.operators.checks import check_bounds, check_fk, check_unique, magnitude, max_length, not_null
from tickmart.operators.enrich import enrich, price_metrics
from tickmart.streaming.stream import to_instant


def values(spark, column, inputs, ddl="v string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(inputs)], f"n int, {ddl}")
    return [r[0] for r in rows.orderBy("n").select(column(F.col("v"))).collect()]


def at(s):
    return dt.datetime.fromisoformat(s)


def test_volume_is_cut_not_rounded(spark):
    assert values(spark, text.to_volume, ["2.0", "2.9", " 15 ", "", "  ", "x", None, "-3.7"]) == [
        2, 2, 15, None, None, None, None, -3,
    ]


def test_price_and_date_text(spark):
    assert values(spark, text.to_price, [" 1.5 ", "", "abc", "1234567890123.0", None]) == [D("1.5"), None, None, None, None]
    assert values(spark, text.to_trade_date, [" 2024-01-02 09:30:00 ", "2024-01-02t09:30:00", "soon", "", None]) == [
        at("2024-01-02 09:30"), at("2024-01-02 09:30"), None, None, None,
    ]


def test_symbol_spellings_share_a_key(spark):
    assert set(values(spark, text.canonical_symbol, ["BF_B", "BF-B", "BF.B", "bfb"])) == {"bfb"}
    assert values(spark, text.api_symbol, ["BF_B"]) == ["BF-B"]


def test_symbol_classes(spark):
    assert values(spark, text.classify_symbol, ["IRX", "DJI", "GCF", "CLF", "AAPL"]) == [
        "bond", "index", "commodity", "commodity", "stock",
    ]


def test_hash_skips_missing_parts(spark):
    row = spark.createDataFrame([("A", " d ", None)], "s string, d string, c string")
    hashed, same = row.select(text.audit_hash(F.col("s"), F.col("d"), F.col("c")), F.md5(F.lit("Ad"))).first()
    assert hashed == same


QUALITY = [
    ((2, 3, 1, 2, 5), True),
    ((0, 0, 0, 0, 0), True),
    ((1, 1, 1, 1, 1), True),
    ((None, 3, 1, 2, 5), False),
    ((2, None, 1, 2, 5), False),
    ((2, 3, None, 2, 5), False),
    ((2, 3, 1, None, 5), False),
    ((2, 3, 1, 2, None), False),
    ((-2, 3, -3, 2, 5), False),
    ((2, 3, 1, -2, 5), False),
    ((2, 3, 1, 2, -5), False),
    ((2, 1, 3, 2, 5), False),
    ((4, 3, 1, 2, 5), False),
    ((2, 3, 1, 0, 5), False),
]


def test_clean_flag(spark):
    ddl = "n int, trade_date timestamp_ntz, " + ", ".join(f"{p}_price decimal(18,6)" for p in ("open", "high", "low", "close"))
    rows = [(n, at("2024-01-02"), *[None if x is None else D(x) for x in v[:4]], v[4]) for n, (v, _) in enumerate(QUALITY)]
    rows.append((len(QUALITY), None, D(2), D(3), D(1), D(2), 5))
    flags = spark.createDataFrame(rows, ddl + ", volume bigint").orderBy("n").select(validate.clean_flag()).collect()
    assert [r[0] for r in flags] == [want for _, want in QUALITY] + [False]


LANDING = "symbol string, date string, open string, high string, low string, close string, volume string, _source_name string, _source_filename string, _loaded_at timestamp_ntz"


def landing(spark, rows):
    return spark.createDataFrame([(*r, "CSV Import", "f.csv", at("2024-02-01")) for r in rows], LANDING)


def test_rejects_name_their_fields(spark):
    rows = landing(spark, [
        ("A", "2024-01-02", "1", "1", "1", "1", "1"), ("B", "2024-01-02", "", " ", None, "1", ""),
        ("C", "nope", "x", "1", "1", "1", "y"), ("D", None, "1", "1", "1", "1", "1"), ("E", "2024-01-02", "1", "1", "1", "1", ".5"),
    ])
    got = {r.symbol: r.reject_reason for r in validate.rejected_prices(rows).collect()}
    assert got == {"C": "date,open,volume", "D": "date", "E": "volume"}


def test_staging_keeps_unreadable_prices_as_missing(spark):
    rows = landing(spark, [("A", "2024-01-02", "x", "1", "1", "1", "1"), ("A", "never", "1", "1", "1", "1", "1")])
    (row,) = validate.stage_prices(rows).collect()
    assert row.open_price is None and row._is_cleaned is False and row._is_duplicate is False


def test_one_time_in_two_texts_is_a_duplicate(spark):
    rows = landing(spark, [("A", "2024-01-02", "1", "1", "1", "1", "1"), ("A", "2024-01-02 00:00:00", "2", "2", "2", "2", "1")])
    (row,) = validate.stage_prices(rows).collect()
    assert row._is_duplicate and row.open_price == 2


def test_time_bucket(spark):
    ts = [at("2024-01-02 09:44:59.999999"), at("2024-01-02 00:00")]
    for minutes, want in ((15, "09:30"), (7, "09:42"), (45, "09:00"), (1, "09:44"), (60, "09:00")):
        got = values(spark, lambda c, m=minutes: time_bucket(c, m), ts, "v timestamp_ntz")
        assert got == [at(f"2024-01-02 {want}"), at("2024-01-02 00:00")]


# pre market, regular, after hours, early close
SESSIONS = {
    "2024-03-05 09:29": (True, False, False, False),
    "2024-03-05 09:30": (False, True, False, False),
    "2024-03-05 13:00": (False, True, False, False),
    "2024-03-05 16:00": (False, True, False, False),
    "2024-03-05 16:01": (False, False, True, False),
    "2024-07-03 12:59": (False, True, False, False),
    "2024-07-03 13:00": (False, False, True, True),
    "2024-07-03 16:00": (False, False, True, True),
    "2024-07-03 09:29": (True, False, False, False),
    "2024-12-24 13:00": (False, False, True, True),
    "2024-11-29 13:00": (False, False, True, True),
    "2024-11-28 13:00": (False, True, False, False),
    "2024-11-22 13:00": (False, True, False, False),
}


def test_sessions(spark):
    rows = spark.createDataFrame([(at(t),) for t in SESSIONS], "v timestamp_ntz")
    c = calendar_columns(F.col("v"))
    flags = rows.select("v", c["is_pre_market"], c["is_regular_session"], c["is_after_hours"], c["is_early_close"])
    assert {r[0]: tuple(r[1:]) for r in flags.collect()} == {at(t): f for t, f in SESSIONS.items()}


def test_calendar_edges(spark):
    days = [at("2024-12-30 23:59:58"), at("2024-01-07"), at("2024-01-08"), at("2023-01-29")]
    rows = spark.createDataFrame([(d,) for d in days], "v timestamp_ntz")
    c = calendar_columns(F.col("v"))
    got = rows.select(*[c[n].alias(n) for n in ("sk_date_id", "week_of_year", "week_of_month", "day_of_week", "day_name", "is_weekend")])
    assert [tuple(r) for r in got.collect()] == [
        (20241230235958, 1, 5, 1, "Monday", False), (20240107000000, 1, 1, 0, "Sunday", True),
        (20240108000000, 2, 2, 1, "Monday", False), (20230129000000, 4, 5, 0, "Sunday", True),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 did not exist in New York that night
        night = at("2024-03-10 02:38:30")
        got = values(spark, lambda v: F.struct(time_bucket(v, 15), time_bucket(v, 7), smart_key(v)), [night], "v timestamp_ntz")
        assert tuple(got[0]) == (at("2024-03-10 02:30"), at("2024-03-10 02:35"), 20240310023830)
        times = [at("2024-03-10 02:38:30.123456"), at("2024-11-03 01:10"), at("1969-12-31 23:59:59.999999")]
        rows = spark.createDataFrame([(t,) for t in times], "v timestamp_ntz").withColumn("i", to_instant("v"))
        got = rows.select(F.unix_micros("i")).collect()
        epoch = at("1970-01-01")
        assert [r[0] for r in got] == [round((t - epoch) / dt.timedelta(microseconds=1)) for t in times]
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_key_month(spark):
    assert values(spark, key_month, [20240310023830], "v bigint") == [202403]


BARS = (
    "symbol string, symbol_type string, interval_start timestamp_ntz, timezone string, open decimal(18,6), "
    "high decimal(18,6), low decimal(18,6), close decimal(18,6), volume bigint, trade_count int, granularity string"
)


def bars(spark, rows):
    """rows of (symbol, start, price, volume); all four prices equal."""
    full = [
        (s, "stock", at(t), "z", *([None if p is None else D(p)] * 4), v, 1, "15min") for s, t, p, v in rows
    ]
    return spark.createDataFrame(full, BARS)


def test_vwap_and_previous_close(spark):
    rows = [
        ("A", "2024-01-02 09:30", 10, 0), ("A", "2024-01-02 09:45", 20, 1), ("A", "2024-01-02 10:00", 30, 0),
        ("A", "2024-01-02 10:15", 40, 3), ("A", "2024-01-05 09:30", 50, 2), ("A", "2024-01-05 09:45", None, 2),
        ("A", "2024-01-05 10:00", 70, 2), ("A", "2024-03-05 10:00", 5, None), ("B", "2024-01-02 09:30", 1, 7),
    ]
    got = enrich(bars(spark, rows)).orderBy("symbol", "interval_start").select("vwap", "previous_close").collect()
    assert [r.vwap for r in got] == [None, 20, None, 35, 50, 25, 40, None, 1]
    assert [r.previous_close for r in got] == [None, 10, 20, 30, 40, 50, None, 70, None]


def test_price_change(spark):
    rows = spark.createDataFrame(
        [(D(2), None), (D(2), D(0)), (D(3), D(2)), (D(1), D(3)), (D(300), D(2)), (None, D(2))],
        "close decimal(18,6), previous_close decimal(18,6)",
    ).withColumns({"high": F.col("close"), "low": F.lit(1).cast("decimal(18,6)")})
    got = price_metrics(rows).collect()
    assert [r.price_change_pct for r in got] == [0, 0, 50, D("-66.667"), 14900, None]
    assert [r.price_change for r in got] == [None, 2, 1, -2, 298, None]


def test_trade_status(spark):
    assert values(spark, measures.trade_status, [0, 1, 2, 3], "v int") == ["non-existent", "partial", "partial", "complete"]


def test_bar_of_ticks_keeps_missing_ends(spark):
    ticks = spark.createDataFrame(
        [("A", "stock", "z", at(f"2024-01-02 09:3{n}"), o, D(9), D(n), c, v)
         for n, o, c, v in ((1, None, D(1), 1), (2, D(2), D(2), None), (3, D(3), None, 4))],
        "ticker_symbol string, symbol_type string, timezone string, trade_date timestamp_ntz, open_price decimal(18,6), "
        "high_price decimal(18,6), low_price decimal(18,6), close_price decimal(18,6), volume bigint",
    )
    (bar,) = to_bars(ticks).collect()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.trade_count) == (None, 9, 1, None, 5, 3)


def test_range_of_no_bars(spark):
    assert tuple(bar_range(bars(spark, []), F.localtimestamp()).first()) == (None, None, None, 0)


def test_dense_keys(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    ids = dims.assign_keys(rows.repartition(7), "k", "sk", start=50)
    assert sorted(r.sk for r in ids.collect()) == list(range(51, 1051))
    again = dims.assign_keys(rows.repartition(3), "k", "sk", start=50)
    assert {(r.k, r.sk) for r in ids.collect()} == {(r.k, r.sk) for r in again.collect()}


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "bb"), (2, None), (None, "c"), (None, "d")], "k int, s string")
    assert check_unique(rows, ["k"], "k").first().violations == 1
    bounds = check_bounds(rows, {"k": not_null("k"), "short": max_length("s", 1), "small": magnitude("k", 2)})
    assert {r.rule: r.violations for r in bounds.collect()} == {"k": 2, "short": 1, "small": 1}
    dim = spark.createDataFrame([(1,)], "id int")
    assert check_fk(rows, "k", dim, "id", "fk").first().violations == 1


def test_companies_are_matched_by_any_spelling(spark):
    attributes = {c: F.lit(None).cast("string") for c in ("ceo", "currency", "sector", "industry", "country", "state", "city", "zip", "address")}
    rows = spark.createDataFrame([("BF_B", "old"), ("A", "a")], "symbol string, company_name string").withColumns(attributes)
    rows = rows.withColumns({"full_time_employees": F.lit(1), "ipo_date": F.current_date(), **{c: F.lit(True) for c in ("is_active", "is_etf", "is_fund")}})
    from tickmart.schemas import TABLES

    empty = spark.createDataFrame([], TABLES["dim_company"][0])
    first = dims.upsert_company(empty, dims.company_rows(rows, F.localtimestamp()))
    first = spark.createDataFrame(first.collect(), first.schema)
    assert sorted(r.sk_company_id for r in first.collect()) == [1, 2]
    renamed = rows.where("symbol = 'BF_B'").withColumns({"symbol": F.lit("BF-B"), "company_name": F.lit("new"), "sector": F.lit("x")})
    (changed,) = dims.upsert_company(first, dims.company_rows(renamed, F.localtimestamp())).collect()
    assert (changed.symbol, changed.company_name, changed.sector) == ("BF_B", "new", None)
