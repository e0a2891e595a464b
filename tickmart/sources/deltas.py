"""Changes that are written beside a table and take effect when it is read.

A change names rows by their keys and, where whole days are rebuilt, the days that lose all they had.
Changes of several tables count together once they are committed, and cost what they contain, however
large the month is that they belong to. A month of many changes is rewritten as a whole, later.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tickmart.sources.tables import Warehouse

#: Month -> committed versions that are not part of the table's own files yet.
Live = dict[int, list[int]]


@dataclass(frozen=True)
class Rule:
    """``keys`` name a row of a month, ``owner`` and ``day`` (of the column ``at``) what a tombstone
    covers."""

    keys: tuple[str, ...]
    owner: str
    at: str

    def day(self) -> Column:
        at = F.col(self.at)
        # a smart key's day is its first eight digits
        return F.floor(at / 1_000_000).cast("bigint") if self.at == "fk_date_id" else F.unix_date(at.cast("date")).cast("bigint")


RULES = {
    "agg_15min_raw": Rule(("symbol", "interval_start"), "symbol", "interval_start"),
    "bar_days": Rule(("symbol", "trade_day"), "symbol", "trade_day"),
    "fact_15min_stock_price": Rule(("fk_date_id", "fk_instrument_id"), "fk_instrument_id", "fk_date_id"),
}


def of_versions(live: Live) -> Column:
    return reduce(or_, [(F.col("yyyymm") == m) & F.col("_version").isin(sorted(vs)) for m, vs in sorted(live.items())])


def merged(base: DataFrame, changes: DataFrame, live: Live, rule: Rule) -> DataFrame:
    """``base`` with the changes of ``live`` applied: months without any are a plain scan.

    Of a key the latest change counts. A tombstone takes what its owner had that day in earlier
    versions, so a base row stays if neither its day nor its key is in the changes. Only the base's rows of
    changed months take part in joins, against the changes' days and keys, which Spark broadcasts
    while they are small.
    """
    scope = ["yyyymm", rule.owner, "_day"]
    changes = changes.where(of_versions(live)).withColumn("_day", rule.day())
    tombs = changes.where("_gone").groupBy(*scope).agg(F.max("_version").alias("_since"))
    written = changes.where("not _gone")
    rest = [c for c in base.columns if c not in ("yyyymm", *rule.keys)]
    latest = written.groupBy("yyyymm", *rule.keys).agg(F.max_by(F.struct("_version", "_day", *rest), "_version").alias("_last"))
    latest = latest.select("yyyymm", *rule.keys, "_last.*").join(tombs, scope, "left").where("_since is null or _version >= _since")
    months = sorted(live)
    old = base.where(F.col("yyyymm").isin(months)).withColumn("_day", rule.day())
    old = old.join(tombs, scope, "left_anti").join(written.select("yyyymm", *rule.keys), ["yyyymm", *rule.keys], "left_anti")
    untouched = base.where(~F.col("yyyymm").isin(months))
    return untouched.unionByName(old.select(*base.columns)).unionByName(latest.select(*base.columns))


class Changes:
    """Changes of one run. Until ``commit`` nobody else sees them; those of a run that broke off are
    never read, and their files are replaced or ignored."""

    def __init__(self, wh: Warehouse):
        self.wh = wh
        newest, self.live = wh.change_state()
        self.version = newest + 1
        self.months: dict[str, list[int]] = {}

    def seen(self, name: str) -> Live:
        """The versions of a table, with those of this run."""
        live = {month: list(versions) for month, versions in self.live.get(name, {}).items()}
        for month in self.months.get(name, []):
            live.setdefault(month, []).append(self.version)
        return live

    def put(self, name: str, rows: DataFrame, gone: DataFrame | None = None) -> None:
        """Replace rows by key, and all that the days of ``gone`` had (its owner, a time of the day and
        the month). Both must be cheap to read (written)."""
        written = rows.withColumn("_gone", F.lit(False))
        if gone is not None:
            written = written.unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        # a list of months, never rows
        months = {r[0] for r in written.select("yyyymm").distinct().collect()}
        self.months[name] = sorted(months)
        if months:
            self.wh.write_changes(written.withColumn("_version", F.lit(self.version).cast("bigint")), name)

    def commit(self) -> None:
        """One append: all tables change at once. Months of very many changes are then rewritten."""
        rows = [(name, month, self.version, False) for name, months in self.months.items() for month in months]
        if rows:
            self.wh.note_changes(rows)
        for name in self.months:
            if any(len(versions) > self.wh.most_changes for versions in self.seen(name).values()):
                self.wh.settle(name, self.wh.most_changes)
