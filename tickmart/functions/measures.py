"""Price measures as column expressions; all arithmetic is exact decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(18,6)"
# any difference of two prices fits, and any percentage of the smallest price there is
DIFFERENCE, PERCENT = "decimal(19,6)", "decimal(24,3)"


def trade_status(trade_count: Column) -> Column:
    return (
        F.when(trade_count == 0, "non-existent").when(trade_count < 3, "partial").otherwise("complete")
    )


def price_change(close: Column, previous: Column) -> Column:
    return (close - previous).cast(DIFFERENCE)


def price_change_pct(close: Column, previous: Column) -> Column:
    """Percent with three digits; 0 without a usable previous close."""
    pct = ((close - previous) * 100 / previous).cast(PERCENT)
    return F.when(previous.isNull() | (previous == 0), F.lit(0).cast(PERCENT)).otherwise(pct)


def price_range(high: Column, low: Column) -> Column:
    return (high - low).cast(DIFFERENCE)


def vwap(volume: Column, weighted: Column, total: Column) -> Column:
    """``weighted`` is the running sum of (high+low+close)*volume, ``total`` that of volume.

    The three prices are averaged by the one division here: dividing each bar by 3 first would
    round every bar.
    """
    return F.when(volume == 0, None).otherwise((weighted / F.nullif(total * 3, F.lit(0))).try_cast(PRICE))


def percent(part: Column, whole: Column) -> Column:
    """part/whole*100 as a double with six digits (query outputs)."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100, 6)


def mean(value: Column) -> Column:
    """Average as an exact decimal sum over a count, with six digits."""
    return F.round(F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0)), 6)
