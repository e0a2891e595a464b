"""Data checks that report rule -> number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Keys held by more than one row. NULL keys do not clash."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = df.where(known).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def check_bounds(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, all counted in one pass. A rule that is NULL for a row is broken."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
        ).alias("r")
    ).select("r.*")


def watch(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """check_bounds without a pass of its own: the rows are counted on their way into what is written
    next. A task that runs again may count its rows again, so a rule that holds has no violation, and
    one that is broken has at least those reported once."""
    seen = Observation()
    counts = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()]
    return df.observe(seen, *counts), seen


def violated(seen: Observation) -> dict[str, int]:
    """The broken rules of ``watch``, once the rows are written."""
    return {rule: n for rule, n in seen.get.items() if n}


def check_fk(fact: DataFrame, fk: str, dim: DataFrame, key: str, rule: str) -> DataFrame:
    """Fact rows whose key is not in the dimension. Facts shrink to one row per key first."""
    used = fact.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(F.count("*").alias("n"))
    dangling = used.join(dim.select(key), key, "left_anti")
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")
    return dangling.agg(total).select(F.lit(rule).alias("rule"), "violations")


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def max_length(column: str, n: int) -> Column:
    return F.col(column).isNull() | (F.length(column) <= n)


def magnitude(column: str, limit: int) -> Column:
    """|value| below ``limit``; NULL passes."""
    return F.col(column).isNull() | (F.abs(column) < limit)
