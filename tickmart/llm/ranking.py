"""Positions in a global order without a window that holds one whole key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], bucket: str, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the row's position from 0 among the rows of ``keys``.

    ``bucket`` splits a key: rows of a lower bucket come first, and only the rows of one bucket are
    sorted together. ``df`` must be cheap to read (written), as it is read twice. Null keys and
    buckets are values like any other.
    """
    within = Window.partitionBy(*keys, bucket).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*keys, bucket).agg(F.count("*").alias("_n"))
    starts = starts.select(
        *[F.col(k).alias(f"_{k}") for k in [*keys, bucket]], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    same = F.lit(True)
    for k in [*keys, bucket]:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    numbered = df.withColumn("_row", F.row_number().over(within))
    joined = numbered.join(starts, same)
    return joined.withColumn(name, F.col("_start") + F.col("_row") - 1).drop("_row", "_start", *[f"_{k}" for k in [*keys, bucket]])
