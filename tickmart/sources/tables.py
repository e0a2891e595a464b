"""Reading and writing the tables of one warehouse folder.

Tables are Parquet folders. Landing and the logs only ever grow and are the record; staging, bars
and facts can be rebuilt from what they came from. Bars and facts take changes in files of their own
(``deltas``) until a month has many and is rewritten. One writer at a time: Parquet has no
transactions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.schemas import FILE_ORDER, ONE_PARTITION_A_WRITE, TABLES
from tickmart.session import materialize
from tickmart.sources.deltas import RULES, Changes, Live, merged


class Warehouse:
    """``staging_unit`` is the span of a staging partition: 'day' once a month of ticks is more
    than a rewrite should touch (hundreds of GB), 'month' below that. A month with more than
    ``most_changes`` versions of changes is rewritten by the load that finds it so."""

    def __init__(self, spark: SparkSession, root: str, staging_unit: str = "month", most_changes: int = 24):
        if staging_unit not in ("day", "month"):
            raise ValueError(staging_unit)
        self.spark = spark
        self.root = root.rstrip("/")
        self.staging_unit = staging_unit
        self.most_changes = most_changes

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, changes: Changes | None = None) -> DataFrame:
        """The table, or an empty frame of its layout when nothing was written yet; with ``changes``
        as it will be once they are committed."""
        rows = self._read_files(name)
        if name not in RULES:
            return rows
        live = self.live_changes(name) if changes is None else changes.seen(name)
        if not live:
            return rows
        schema = T.StructType([*layout(name), T.StructField("_gone", T.BooleanType()), T.StructField("_version", T.LongType())])
        changed = self.spark.read.schema(schema).parquet(self._changes_path(name))
        return merged(rows, changed, live, RULES[name])

    def _read_files(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(layout(name)).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._empty(name)

    def _empty(self, name: str) -> DataFrame:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in layout(name)]
        return self.spark.range(0).select(*nothing)

    def _changes_path(self, name: str) -> str:
        return f"{self.path(name)}__changes"

    def change_state(self) -> tuple[int, dict[str, Live]]:
        """The newest version, and by table and month the versions that are committed and not settled."""
        log = self.path("delta_log")
        if not self._file_system(log).exists(self._hadoop_path(log)):
            return 0, {}
        by_month = self._read_files("delta_log").groupBy("name", "yyyymm").agg(
            F.max("version").alias("newest"),
            F.coalesce(F.max(F.when(F.col("settled"), F.col("version"))), F.lit(0)).alias("done"),
            F.collect_set(F.when(~F.col("settled"), F.col("version"))).alias("versions"),
        )
        # a row a table and month
        rows = by_month.select("name", "yyyymm", "newest", F.filter("versions", lambda v: v > F.col("done")).alias("versions")).collect()
        live: dict[str, Live] = {}
        for r in rows:
            if r["versions"]:
                live.setdefault(r["name"], {})[r["yyyymm"]] = sorted(r["versions"])
        return max((r["newest"] for r in rows), default=0), live

    def live_changes(self, name: str) -> Live:
        return self.change_state()[1].get(name, {})

    def write_changes(self, rows: DataFrame, name: str) -> None:
        parts = ("yyyymm", "_version")
        rows = rows.select(*layout(name).names, "_gone", "_version").hint("rebalance", *parts).sortWithinPartitions(*parts, *RULES[name].keys)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(self._changes_path(name))

    def note_changes(self, rows: list[tuple[str, int, int, bool]]) -> None:
        self.append(self.spark.createDataFrame(rows, "name string, yyyymm int, version bigint, settled boolean").coalesce(1), "delta_log")

    def settle(self, name: str, most: int = 0) -> list[int]:
        """Rewrite the months of over ``most`` versions of changes with these in place; returns them.

        If this breaks off before it is noted, the changes apply to the rewritten months once more,
        which changes nothing.
        """
        live = self.live_changes(name)
        crowded = sorted(m for m, versions in live.items() if len(versions) > most)
        if crowded:
            rows = materialize(self.read(name).where(F.col("yyyymm").isin(crowded)), "settled")
            left = {r[0] for r in rows.select("yyyymm").distinct().collect()}
            self.replace(rows, name)
            self.drop_parts(name, sorted(set(crowded) - left))
            self._settled(name, {m: live[m] for m in crowded})
        return crowded

    def _settled(self, name: str, live: Live) -> None:
        if live:
            self.note_changes([(name, month, max(versions), True) for month, versions in sorted(live.items())])
        for month, versions in live.items():
            for version in versions:
                self._delete(f"{self._changes_path(name)}/yyyymm={month}/_version={version}")

    def _write(self, df: DataFrame, name: str, mode: str, overwrite: str = "dynamic") -> None:
        _, parts = TABLES[name]
        df = df.select(*layout(name).names)
        if parts and name not in ONE_PARTITION_A_WRITE:
            # rebalance brings a partition's rows together (few files) and lets adaptive
            # execution cut a partition that is too big for one task
            df = df.hint("rebalance", *parts)
        if name in FILE_ORDER:
            df = df.sortWithinPartitions(*parts, FILE_ORDER[name])
        writer = df.write.mode(mode).option("partitionOverwriteMode", overwrite)
        writer.partitionBy(*parts).parquet(self.path(name))

    def append(self, df: DataFrame, name: str) -> None:
        self._write(df, name, "append")

    def replace(self, df: DataFrame, name: str) -> None:
        """Replace the partitions ``df`` has rows in; the whole table when it has no partitions.

        ``df`` may read the table itself only if the table is partitioned.
        """
        self._write(df, name, "overwrite")

    def overwrite(self, df: DataFrame, name: str) -> None:
        """Replace the whole table; ``df`` must not read it."""
        self._write(df, name, "overwrite", "static")
        if name in RULES:
            self._settled(name, self.live_changes(name))

    def reset(self, name: str) -> None:
        """Empty the table."""
        _, parts = TABLES[name]
        writer = self._empty(name).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*parts).parquet(self.path(name))
        if name in RULES:
            self._settled(name, self.live_changes(name))

    def _delete(self, path: str) -> None:
        """By Spark's own file system, so that any store works."""
        self._file_system(path).delete(self._hadoop_path(path), True)

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path: str):
        return self._hadoop_path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def compact_log(self, name: str, most_files: int = 64) -> None:
        """Rewrite a log of more files as one. The new file comes first: if this breaks off, the log
        has some rows twice until the next time, and never lacks any."""
        rows = self.read(name)
        old = rows.inputFiles()
        if len(old) > most_files:
            rows.dropDuplicates().coalesce(1).write.mode("append").parquet(self.path(name))
            for file in old:
                self._delete(file)

    def drop_parts(self, name: str, values: list) -> None:
        _, (part, *_) = TABLES[name]
        for value in values:
            self._delete(f"{self.path(name)}/{part}={value}")

    def upsert(
        self, updates: DataFrame, name: str, keys: list[str], parts: list | None = None,
        without: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Replace rows on ``keys``, rewriting only the partitions that ``updates`` touches.

        ``without`` takes further rows out of the stored ones, of the partitions ``parts``, whether or
        not ``updates`` has something in their place. ``updates`` must be cheap to read (written or
        small): it is read more than once. A key always lies in one partition.
        """
        _, (part, *_) = TABLES[name]
        # partition lists: months, days or job names, never rows
        touched = {r[0] for r in updates.select(part).distinct().collect()} | set(parts or [])
        if not touched:
            return
        stored = self.read(name).where(F.col(part).isin(sorted(touched)))
        kept = stored.join(updates.select(part, *keys), [part, *keys], "left_anti")
        if without is not None:
            kept = without(kept)
        rows = kept.unionByName(updates.select(*stored.columns))
        # a partition that keeps nothing is not overwritten, as no row names it
        left = touched if without is None else {r[0] for r in rows.select(part).distinct().collect()}
        live = {m: versions for m, versions in self.live_changes(name).items() if m in touched} if name in RULES else {}
        self.replace(rows, name)
        self.drop_parts(name, sorted(touched - left))
        self._settled(name, live)


@cache
def layout(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name][0])
