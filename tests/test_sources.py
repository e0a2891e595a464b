"""Files as people write them: headers in any order, bad files among good ones."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from tickmart.functions.text import to_trade_date
from tickmart.sources import prices, profiles
from tickmart.sources.tables import Warehouse


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "AAPL.csv").write_text("date,open,high,low,close,volume\n2024-01-02,1,2,0,1,2.0\n2024-01-03,1,2,0,1,\n")
    (path / "BF_B.csv").write_text('﻿volume,close,extra,"date",open,high,low\n5,1.5,"x,y",2024-01-02,1,2,0\n')
    (path / "BAD.csv").write_text("date,open\n2024-01-02,1\n")
    (path / "TWICE.csv").write_text("date,open,high,low,close,volume,date\n2024-01-02,1,2,0,1,2,z\n")
    (path / "EMPTY.csv").write_text("date,open,high,low,close,volume\n")
    (path / "NONE.csv").write_text("")
    (path / "notes.txt").write_text("not prices")
    big = path / "symbol=HOT"
    big.mkdir()
    for n in range(3):
        (big / f"part-{n}.csv").write_text(f"date,open,high,low,close,volume\n2024-01-0{n + 1},1,2,0,1,{n}\n")
    return str(path)


def test_columns_are_bound_by_name_and_bad_files_do_not_stop_good_ones(spark, tmp_path, folder):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices.land_prices(wh, folder)
    rows = wh.read("landing_prices")
    by_symbol = {}
    for r in rows.collect():
        by_symbol.setdefault(r.symbol, []).append((r.date, r.open, r.high, r.low, r.close, r.volume))
    assert sorted(by_symbol["AAPL"]) == [("2024-01-02", "1", "2", "0", "1", "2.0"), ("2024-01-03", "1", "2", "0", "1", None)]
    assert by_symbol["BF_B"] == [("2024-01-02", "1", "2", "0", "1.5", "5")]
    assert len(by_symbol["HOT"]) == 3 and set(by_symbol) == {"AAPL", "BF_B", "HOT"}
    assert {(r._source_name, r._source_filename) for r in rows.where("symbol = 'AAPL'").collect()} == {("CSV Import", "AAPL.csv")}

    log = {r._source_filename: (r.symbol, r.rows, r.status, r.error) for r in wh.read("ingest_log").collect()}
    assert log["AAPL.csv"] == ("AAPL", 2, "success", None)
    assert log["BAD.csv"] == ("BAD", 0, "error", "header lacks or repeats: high, low, close, volume")
    assert log["TWICE.csv"][2:] == ("error", "header lacks or repeats: date")
    assert log["EMPTY.csv"] == ("EMPTY", 0, "success", None)
    assert "NONE.csv" not in log  # Spark lists no file of zero bytes
    assert "notes.txt" not in log and log["part-1.csv"] == ("HOT", 1, "success", None)


def test_rows_of_all_layouts_are_read_in_one_scan(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    orders = ["date,open,high,low,close,volume", "volume,close,low,high,open,date", "x,date,open,high,low,close,volume,y", "date,date"]
    for n, order in enumerate(orders):
        cells = {"date": "2024-01-02", "open": "1", "high": "2", "low": "3", "close": "4", "volume": str(n)}
        row = ",".join(cells.get(c, "?") for c in order.split(","))
        (tmp_path / "in" / f"S{n}.csv").write_text(f"{order}\n{row}\n{order}\n2024-01-03\n")
    rows, files = prices.read_price_files(spark, str(tmp_path / "in"))
    rows.explain()
    assert capsys.readouterr().out.count("FileScan csv") == 1
    got = {}
    for r in rows.collect():
        got.setdefault(r.symbol, []).append(tuple(r)[1:7])
    none = (None,) * 5
    for n, short in enumerate([("2024-01-03", *none), (*none, "2024-01-03"), (None, *none)]):
        # a header that comes again is a row as any other, for the validation to judge
        rows_of = [("2024-01-02", "1", "2", "3", "4", str(n)), ("date", "open", "high", "low", "close", "volume"), short]
        assert sorted(got[f"S{n}"], key=str) == sorted(rows_of, key=str)
    assert set(got) == {"S0", "S1", "S2"} and files.where("error is not null").count() == 1


def test_broken_files_are_found_without_a_list_of_all(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for n in range(40):
        whole = gzip.compress(b"date,open\n2024-01-02,1\n")
        (tmp_path / "in" / f"{n}.csv.gz").write_bytes(b"no gzip" if n in (7, 8, 31) else whole)
    frame, collected = type(spark.range(1)), []
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(plain(self)) or collected[-1])
    found = prices.broken_files(spark, str(tmp_path / "in"), "*.csv*")
    assert sorted(f.rsplit("/", 1)[1] for f in found) == ["31.csv.gz", "7.csv.gz", "8.csv.gz"]
    assert max(map(len, collected)) <= 2


def test_a_folder_of_bad_files_lands_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "X.csv").write_text("a,b\n1,2\n")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices.land_prices(wh, str(tmp_path / "in"))
    assert wh.read("landing_prices").count() == 0 and wh.read("ingest_log").count() == 1


def test_the_first_profile_of_each_response_counts(spark, tmp_path):
    path = tmp_path / "profiles"
    path.mkdir()
    first = {"symbol": "BF-B", "companyName": "B, F", "fullTimeEmployees": "12", "isEtf": False, "isActivelyTrading": True, "beta": 1.2}
    (path / "a.json").write_text(json.dumps([first, {"symbol": "NO"}], indent=1))
    (path / "b.json").write_text("[]")
    (path / "c.json").write_text(json.dumps([{"symbol": "C", "ipoDate": "2001-02-03"}]))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    profiles.land_profiles(wh, str(path))
    got = {r.symbol: r for r in wh.read("landing_profiles").collect()}
    assert set(got) == {"BF-B", "C"}
    row = got["BF-B"]
    assert (row.company_name, row.full_time_employees, row.is_etf, row.is_active, row.is_fund) == ("B, F", "12", "false", "true", None)
    assert (got["C"].ipo_date, got["C"]._source_filename, got["C"]._source_name) == ("2001-02-03", "c.json", "API Import")


def test_sectors(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    (tmp_path / "s.csv").write_text("rank,symbol,sector\n1,A,Tech\n2,B,Energy\n")
    profiles.land_sectors(wh, str(tmp_path / "s.csv"))
    (tmp_path / "twice.csv").write_text("symbol,sector\nA,Tech\nA,Energy\n")
    with pytest.raises(ValueError, match="1 symbols"):
        profiles.land_sectors(wh, str(tmp_path / "twice.csv"))
    rows = wh.read("landing_sectors").collect()
    assert sorted((r.symbol, r.sector, r._source_filename) for r in rows) == [("A", "Tech", "s.csv"), ("B", "Energy", "s.csv")]


def test_reset(spark, tmp_path, folder):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices.land_prices(wh, folder)
    prices.reset_landing(wh)
    assert wh.read("landing_prices").count() == 0 and wh.read("ingest_log").count() == 0
    prices.land_prices(wh, folder)
    assert wh.read("landing_prices").count() == 6


def test_files_of_one_name_are_logged_apart(spark, tmp_path):
    for folder, n in (("x", 2), ("y", 3)):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "AAPL.csv").write_text("date,open,high,low,close,volume\n" + "2024-01-02,1,1,1,1,1\n" * n)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices.land_prices(wh, str(tmp_path / "in"))
    log = {r.path.rsplit("/", 2)[1]: r.rows for r in wh.read("ingest_log").collect()}
    assert log == {"x": 2, "y": 3}


def test_an_unreadable_file_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A.csv").write_text("date,open,high,low,close,volume\n2024-01-02,1,1,1,1,1\n")
    (tmp_path / "in" / "B.csv.gz").write_bytes(b"not compressed at all")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices.land_prices(wh, str(tmp_path / "in"), glob="*.csv*")
    log = {r.symbol: (r.rows, r.status, r.error) for r in wh.read("ingest_log").collect()}
    assert log == {"A": (1, "success", None), "B": (0, "error", "the file cannot be read")}
    assert wh.read("landing_prices").count() == 1


def test_a_file_that_breaks_in_the_middle_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    header, rng = "date,open,high,low,close,volume\n", random.Random(4)
    for symbol in "ABCDE":
        rows = "".join(f"2024-01-02,{rng.random()},1,1,1,1\n" for _ in range(20_000))
        packed = gzip.compress((header + rows).encode())
        (tmp_path / "in" / f"{symbol}.csv.gz").write_bytes(packed[: len(packed) // 2] if symbol in "BE" else packed)
    (tmp_path / "in" / "X.csv").write_text("close,volume,date,open,high,low\n1,1,2024-01-02,1,1,1\n")  # another layout
    wh = Warehouse(spark, str(tmp_path / "wh"))
    prices.land_prices(wh, str(tmp_path / "in"), glob="*.csv*")
    log = {r.symbol: (r.rows, r.status, r.error) for r in wh.read("ingest_log").collect()}
    whole, broken = (20_000, "success", None), (0, "error", "the file cannot be read")
    assert log == {"A": whole, "B": broken, "C": whole, "D": whole, "E": broken, "X": (1, "success", None)}
    assert wh.read("landing_prices").count() == 60_001


def test_a_read_error_after_the_headers_stops_the_landing(spark, tmp_path, monkeypatch):
    """What cannot be read is never taken for the end of its file."""
    (tmp_path / "in").mkdir()
    rows = "".join(f"2024-01-02,{random.random()},1,1,1,1\n" for _ in range(20_000))
    packed = gzip.compress(("date,open,high,low,close,volume\n" + rows).encode())
    file = tmp_path / "in" / "A.csv.gz"
    file.write_bytes(packed)

    def then_breaks(*a, f=prices.file_headers):
        found = f(*a)
        found = prices.materialize(found, "found")
        file.write_bytes(packed[: len(packed) // 2])
        return found

    monkeypatch.setattr(prices, "file_headers", then_breaks)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        prices.land_prices(wh, str(tmp_path / "in"), glob="*.csv*")
    assert wh.read("landing_prices").count() == wh.read("landing_log").count() == 0


def test_sector_lists_of_other_column_orders(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text("rank,symbol,sector\n1,A,Tech\n")
    (tmp_path / "s" / "b.csv").write_text("sector,symbol\nEnergy,B\n")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    profiles.land_sectors(wh, str(tmp_path / "s"))
    assert sorted((r.symbol, r.sector) for r in wh.read("landing_sectors").collect()) == [("A", "Tech"), ("B", "Energy")]
    (tmp_path / "s" / "c.csv").write_text("symbol\nC\n")
    with pytest.raises(ValueError, match="lacks"):
        profiles.land_sectors(wh, str(tmp_path / "s"))


@pytest.mark.parametrize("text, want", [
    ("2024-01-02", "2024-01-02 00:00:00"), ("2024-1-2 9:30", "2024-01-02 09:30:00"), (" 2024-01-02t09:30:15.250 ", "2024-01-02 09:30:15.250000"),
    ("2024-01-02 09:30 am", "2024-01-02 09:30:00"), ("2024-01-02 12:05 AM", "2024-01-02 00:05:00"), ("2024-01-02 12:05:01pm", "2024-01-02 12:05:01"),
    ("01/02/2024", "2024-01-02 00:00:00"), ("1/2/2024 4:00 PM", "2024-01-02 16:00:00"), ("2024", None), ("2024-01", None), ("2024-02-30", None),
    ("2024-01-02 25:00", None), ("2024-01-02 13:00 PM", None), ("2024-01-02 00:10 AM", None), ("x", None), ("", None), (None, None), ("2024-01-02 09:61", None),
])
def test_forms_of_dates(spark, text, want):
    found = spark.createDataFrame([(text,)], "d string").select(to_trade_date(F.col("d"))).first()[0]
    assert (found and str(found)) == want
