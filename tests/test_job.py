"""The jobs end to end, from files to facts."""

import json

import pytest

from tickmart import job
from tickmart.sources.tables import Warehouse
from tickmart.registry.queries import natural_fact


def write_prices(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("date,open,high,low,close,volume\n" + "".join(f"2024-01-{d},{p},{p},{p},{p},{v}\n" for d, p, v in rows))


def test_files_to_facts(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))

    def run(*args):
        job.run(spark, ["--warehouse", wh.root, *map(str, args)])

    profile = tmp_path / "profiles"
    profile.mkdir()
    (profile / "p.json").write_text(json.dumps([{"symbol": "BF-B", "companyName": "B", "exchange": "X", "currency": "USD"}]))
    write_prices(tmp_path / "one", "BF_B.csv", [("02 09:30", 10, "2.0"), ("02 09:40", 11, 3), ("03 09:30", 12, "")])
    write_prices(tmp_path / "one", "IRX.csv", [("02 09:30", 1, 1)])
    write_prices(tmp_path / "two", "BF_B.csv", [("02 09:45", 20, 4)])

    run("reset-landing")
    run("land-profiles", profile)
    run("land-prices", tmp_path / "one")
    run("load")
    run("load")  # nothing new
    run("land-prices", tmp_path / "two")
    run("load", "--clear-bars")
    after = sorted(natural_fact(wh).collect())
    assert [(r.symbol, r.fk_date_id, r.previous_close, r.volume) for r in after] == [
        ("BF_B", 20240102093000, None, 5), ("BF_B", 20240102094500, 11, 4), ("BF_B", 20240103093000, 20, None),
        ("IRX", 20240102093000, None, 1),
    ]
    assert wh.read("agg_15min_raw").count() == 0
    company = wh.read("dim_company").first()
    fact = wh.read("fact_15min_stock_price")
    assert company.company_name == "B" and fact.where(f"fk_company_id = {company.sk_company_id}").count() == 3
    assert {r.agg_status for r in wh.read("dim_trade_status").collect()} == {"partial"}
    run("load", "--full")
    assert sorted(natural_fact(wh).collect()) == after

    # a stream goes on where batches ended, and then has landing to itself
    write_prices(tmp_path / "three", "IRX.csv", [("02 10:00", 3, 1)])
    run("land-prices", tmp_path / "three")
    run("stream")
    (new,) = set(natural_fact(wh).collect()) - set(after)
    assert (new.symbol, new.fk_date_id, new.previous_close) == ("IRX", 20240102100000, 1)
    with pytest.raises(RuntimeError, match="stream"):
        run("load")
    after = sorted([*after, new])

    other = Warehouse(spark, str(tmp_path / "streamed"))
    wh.read("landing_prices").write.partitionBy("load_date").parquet(other.path("landing_prices"))
    job.run(spark, ["--warehouse", other.root, "stream"])
    assert sorted(natural_fact(other).collect()) == after
