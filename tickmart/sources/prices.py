"""Price files: CSV with a header, columns bound by header name."""

from __future__ import annotations

import csv
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tickmart.schemas import PRICE_TEXT
from tickmart.session import materialize
from tickmart.sources.tables import Warehouse

SOURCE_NAME = "CSV Import"


def file_symbol(path: Column) -> Column:
    """``<SYMBOL>.csv``, or any file below a ``symbol=<SYMBOL>`` folder (a large symbol's parts)."""
    folder = F.regexp_extract(path, r"/symbol=([^/]+)/", 1)
    name = F.regexp_extract(path, r"([^/]+?)(?:\.csv)?(?:\.[a-z0-9]+)?$", 1)
    return F.url_decode(F.when(folder != "", folder).otherwise(name))


def list_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """_path of every file below a folder; nothing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return files.load(path).select(F.col("path").alias("_path"))


def _options(reader: DataFrameReader, glob: str) -> DataFrameReader:
    # a read error stops the task, which is tried again; no file is cut short
    return reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("ignoreCorruptFiles", False)


def _without(rows: DataFrame, files: list[str]) -> DataFrame:
    """Rows of the other files; these are not opened."""
    return rows.where(~F.col("_metadata.file_path").isin(files)) if files else rows


def file_headers(spark: SparkSession, path: str, glob: str = "*.csv", broken: list[str] | None = None) -> DataFrame:
    """(_path, header) of every file with a first line, but for ``broken`` ones. Files are read to
    their end, so this fails if one cannot be."""
    lines = _without(_options(spark.read, glob).text(path), broken or []).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_n"), F.trim(F.regexp_replace("value", "^\ufeff", "")).alias("header"),
    )
    return lines.where("_start = 0").groupBy("_path").agg(F.min_by("header", "_n").alias("header"))


def _is_read_error(error: Exception) -> bool:
    return "FAILED_READ_FILE" in str(error)


def broken_files(spark: SparkSession, path: str, glob: str = "*.csv") -> list[str]:
    """Paths of the files that cannot be read to their end, however often their task is tried.

    Found by halving: files are read together, and apart if that fails, so a few broken ones among
    n files cost a few jobs times log n. Halves are told by a hash of the path, which Spark applies to its
    listing, so others are not opened and the driver holds the broken paths alone.
    """
    lines = _options(spark.read, glob).text(path)
    listed = _options(spark.read.format("binaryFile"), glob).load(path).select(F.col("_metadata.file_path").alias("_path"))
    todo, broken = [(1, 0)], []
    while todo:
        parts, number = todo.pop()
        mine = lambda of: F.pmod(F.xxhash64(of), F.lit(parts)) == number  # noqa: B023, E731
        try:
            lines.where(mine("_metadata.file_path")).count()
        except Exception as error:
            if not _is_read_error(error):
                raise
            some = [r["_path"] for r in listed.where(mine("_path")).limit(2).collect()]
            if len(some) > 1:
                todo += [(2 * parts, number), (2 * parts, number + parts)]
            else:
                broken += some
    return broken


def _readable(spark: SparkSession, path: str, glob: str) -> tuple[DataFrame, list[str]]:
    """Headers (written), and the paths of the broken files, which are looked for only if there are some."""
    try:
        return materialize(file_headers(spark, path, glob), "headers"), []
    except Exception as error:
        if not _is_read_error(error):
            raise
    broken = broken_files(spark, path, glob)
    return materialize(file_headers(spark, path, glob, broken), "headers"), broken


def read_price_files(spark: SparkSession, path: str, glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """All-text price rows with symbol and path; and every file's path, with an error if the file or
    its header cannot be used.

    One pass finds the headers and one reads the rows, however many layouts there are: Spark reads columns
    by position, and those of a name lie where its file's header has them. The driver holds the layouts,
    of which there are a few, not the files. A file that breaks off before its end is an error as a whole, and
    none of its rows are read; a read error that passes fails the task, which Spark tries again.
    """
    headers, broken = _readable(spark, path, glob)
    layouts, errors = {}, []
    # one row per layout: files of one kind share their header
    found = [r["header"] for r in headers.groupBy("header").count().orderBy("header").collect()]
    for header in found:
        names = [name.strip() for name in next(csv.reader([header]), [])]
        lacking = [c for c in PRICE_TEXT if names.count(c) != 1]
        if lacking:
            errors.append((header, "header lacks or repeats: " + ", ".join(lacking)))
        else:
            layouts[header] = names
    rows = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*PRICE_TEXT, "_path")))
    if layouts:
        ddl = ", ".join(f"_c{i} string" for i in range(max(len(names) for names in layouts.values())))
        reader = _options(spark.read.schema(ddl).option("header", True).option("enforceSchema", True), glob)
        rows = _without(reader.csv(path), broken).select("*", F.col("_metadata.file_path").alias("_path"))
        if len(found) > 1:
            rows = rows.join(headers.where(F.col("header").isin(list(layouts))), "_path")
        rows = rows.select(*[_column(name, layouts, len(found) > 1).alias(name) for name in PRICE_TEXT], "_path")
    rows = rows.select(file_symbol(F.col("_path")).alias("symbol"), *PRICE_TEXT, "_path")
    wrong = spark.createDataFrame(errors, "header string, error string")
    files = list_files(spark, path, glob).join(headers, "_path", "left").join(F.broadcast(wrong), "header", "left")
    unread = F.when(F.col("header").isNull(), F.lit("the file cannot be read"))
    return rows, files.select("_path", F.coalesce("error", unread).alias("error"))


def _column(name: str, layouts: dict[str, list[str]], several: bool) -> Column:
    """Where ``header`` has the name; the only layout needs no header."""
    places: dict[int, list[str]] = {}
    for header, names in layouts.items():
        places.setdefault(names.index(name), []).append(header)
    if not several:
        return F.col(f"_c{next(iter(places))}")
    return F.coalesce(*[F.when(F.col("header").isin(headers), F.col(f"_c{i}")) for i, headers in places.items()])


def tag_lineage(rows: DataFrame, source_name: str, filename: Column, loaded_at: Column | None = None) -> DataFrame:
    stamp = loaded_at if loaded_at is not None else F.localtimestamp()
    return rows.withColumns(
        {"_source_name": F.lit(source_name), "_source_filename": filename, "_loaded_at": stamp}
    )


def _file_name(path: Column) -> Column:
    return F.url_decode(F.regexp_extract(path, "([^/]+)$", 1))


def land_prices(wh: Warehouse, path: str, loaded_at: dt.datetime | None = None, glob: str = "*.csv") -> None:
    """Append a folder of price files to landing and log every file, read or not."""
    stamp = F.lit((loaded_at or dt.datetime.now()).isoformat(" ")).cast("timestamp_ntz")
    rows, files = read_price_files(wh.spark, path, glob)
    landing = append_landing(wh, tag_lineage(rows, SOURCE_NAME, _file_name(F.col("_path")), stamp), complete=False)
    # counted from the landed table, so the files are read once
    landed = wh.read("landing_prices").where((F.col("load_date") == F.to_date(stamp)) & (F.col("_landing") == landing))
    wh.append(ingest_log(landed, files).withColumns({"_loaded_at": stamp, "_landing": F.lit(landing)}), "ingest_log")
    complete_landing(wh, landing)


def append_landing(wh: Warehouse, landed: DataFrame, complete: bool = True) -> str:
    """Append rows as one landing and return its id. Landings have ids of their own, and are staged
    once they are complete, so clocks and overlaps of landings do not matter. One that broke off is
    never staged; land it again."""
    landing = uuid.uuid4().hex
    if "_path" not in landed.columns:
        landed = landed.withColumn("_path", F.lit(None).cast("string"))
    wh.append(landed.withColumns({"load_date": F.to_date("_loaded_at"), "_landing": F.lit(landing)}), "landing_prices")
    if complete:
        complete_landing(wh, landing)
    return landing


def complete_landing(wh: Warehouse, landing: str) -> None:
    days = wh.read("landing_prices").where(F.col("_landing") == landing).select("_landing", "load_date").distinct()
    wh.append(days.coalesce(1), "landing_log")


def reset_landing(wh: Warehouse) -> None:
    for name in ("landing_prices", "landing_sectors", "landing_profiles", "ingest_log", "landing_log", "staged_landings"):
        wh.reset(name)


def ingest_log(landed: DataFrame, files: DataFrame) -> DataFrame:
    """A row per file: how many rows landed, or why it was left out. Files of equal names are told
    apart by their paths."""
    path = F.col("_path")
    counts = landed.groupBy("_path").agg(F.count("*").alias("rows"))
    return files.join(counts, "_path", "left").select(
        _file_name(path).alias("_source_filename"),
        path.alias("path"),
        file_symbol(path).alias("symbol"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"),
        "error",
    )
