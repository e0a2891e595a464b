"""Sector lists (CSV) and company profiles (JSON responses)."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.checks import check_unique
from tickmart.schemas import PROFILE_TEXT
from tickmart.sources.prices import SOURCE_NAME, file_headers, tag_lineage
from tickmart.sources.tables import Warehouse

# Field of the JSON response for each profile column, where the names differ.
JSON_FIELDS = {
    "company_name": "companyName",
    "exchange_full_name": "exchangeFullName",
    "full_time_employees": "fullTimeEmployees",
    "ipo_date": "ipoDate",
    "is_active": "isActivelyTrading",
    "is_etf": "isEtf",
    "is_fund": "isFund",
}


def read_sectors(spark: SparkSession, path: str) -> DataFrame:
    """symbol, sector from CSV files, bound by the names in each file's header."""
    headers = file_headers(spark, path)
    frames = []
    # one row per layout: files of one kind share their header
    for header in [r[0] for r in headers.select("header").distinct().orderBy("header").collect()]:
        names = [name.strip() for name in next(csv.reader([header]), [])]
        if names.count("symbol") != 1 or names.count("sector") != 1:
            raise ValueError(f"a sector list lacks or repeats symbol or sector: {header}")
        ddl = ", ".join(f"`{n if n in ('symbol', 'sector') else f'_x{i}'}` string" for i, n in enumerate(names))
        rows = spark.read.schema(ddl).option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path)
        rows = rows.select("symbol", "sector", F.col("_metadata.file_name").alias("_source_filename"), F.col("_metadata.file_path").alias("_path"))
        frames.append(rows.join(headers.where(F.col("header") == header), "_path", "left_semi").drop("_path"))
    empty = spark.createDataFrame([], "symbol string, sector string, _source_filename string")
    return reduce(DataFrame.unionByName, frames, empty)


def json_field(column: str) -> str:
    return JSON_FIELDS.get(column, column)


def read_profiles(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """The first profile of each response, as text columns.

    A response is an array of profiles: one file each, or one line each (``whole_files=False``,
    for many responses in a file). Empty responses give no row.
    """
    fields = ",".join(f"{json_field(c)}:string" for c in PROFILE_TEXT)
    text = spark.read.text(path, wholetext=whole_files)
    first = F.get(F.from_json("value", f"array<struct<{fields}>>"), F.lit(0))
    rows = text.select(first.alias("p"), F.col("_metadata.file_name").alias("_source_filename"))
    return rows.where("p is not null").select(
        *[F.col("p")[json_field(c)].alias(c) for c in PROFILE_TEXT], "_source_filename"
    )


def land_sectors(wh: Warehouse, path: str) -> None:
    """Replace the sector list. It is not landed if a symbol occurs twice."""
    rows = read_sectors(wh.spark, path)
    repeated = check_unique(rows, ["symbol"], "sector symbol").first()["violations"]
    if repeated:
        raise ValueError(f"{repeated} symbols are listed more than once")
    wh.replace(tag_lineage(rows, SOURCE_NAME, F.col("_source_filename")), "landing_sectors")


def land_profiles(wh: Warehouse, path: str, whole_files: bool = True, loaded_at: Column | None = None) -> None:
    """Append collected profiles; the newest of a symbol counts later on."""
    rows = read_profiles(wh.spark, path, whole_files)
    wh.append(tag_lineage(rows, "API Import", F.col("_source_filename"), loaded_at), "landing_profiles")
