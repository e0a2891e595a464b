"""Joins against tables with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that a hot key's rows are dealt to; each of them gets a copy of a lookup.
SPREAD = 16


def lookup_join(big: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join ``big`` to a lookup that is unique on ``on``.

    A plain join: Spark broadcasts the lookup while its size allows, by the statistics of the files
    or of what was shuffled, and otherwise sorts both sides, in which case adaptive execution splits
    the rows of a hot key, as the lookup has one row to repeat for each part.
    """
    return big.join(lookup, on, how)


def spread_join(big: DataFrame, lookup: DataFrame, on: list[str], spread_by: list[str], how: str = "left") -> DataFrame:
    """The same for keys that may be hot where an outer plan keeps adaptive execution from splitting
    them: rows are told apart by ``spread_by`` and dealt to SPREAD parts."""
    part = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    joined = big.withColumn("_part", part).join(lookup.withColumn("_part", copies), [*on, "_part"], how)
    return joined.drop("_part")
