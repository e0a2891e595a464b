"""Runs registered queries and their SQL on the same tables and compares the rows.

As a script: ``python tests/compare.py [table folder] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb


def database(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda n: names[n])
    return Counter(tuple(cell(row[n]) for n in order) for row in rows)


def difference(spark, db, sf: str, build, sql: str) -> tuple[str, int]:
    df = build(spark, sf)
    expected = db.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}", 0
    want = rows_of(names, expected.fetchall())
    got = rows_of(df.columns, df.collect())
    if want == got:
        return "", sum(got.values())
    extra, lacking = got - want, want - got
    return (
        f"{sum(got.values())} rows instead of {sum(want.values())}; {sum(extra.values())} unexpected, "
        f"like {list(extra)[:2]}; {sum(lacking.values())} lacking, like {list(lacking)[:2]}"
    ), sum(got.values())


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as registry
    from tickmart.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    session, connection = local_session(), database(folder)
    builds, sqls = registry.queries(), registry.oracle_sql()
    wrong = 0
    for name in sys.argv[2:] or builds:
        begun = time.time()
        try:
            message, n = difference(session, connection, folder, builds[name], sqls[name])
        except Exception as error:  # report and go on
            message, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        wrong += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {name} {n} {time.time() - begun:.1f}s {message}", flush=True)
    print(f"{wrong} wrong, no SQL for {sorted(set(builds) - set(sqls))}, no query for {sorted(set(sqls) - set(builds))}")
