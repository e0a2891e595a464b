"""Calendar and trading-session expressions on wall-clock (zone-free) timestamps.

Nothing here goes through a zoned timestamp, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def smart_key(ts: Column) -> Column:
    """yyyymmddhhmiss as a bigint."""
    day = F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    clock = F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)
    return day.cast("bigint") * 1000000 + clock


def yyyymm(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def key_month(key: Column) -> Column:
    """Partition month of a smart key."""
    return F.floor(key / F.lit(100000000)).cast("int")


def cut_minutes(ts: Column, minutes: int) -> Column:
    """``ts`` with its minutes cut to a multiple of ``minutes`` in their hour."""
    past = F.make_dt_interval(mins=F.minute(ts) % minutes, secs=F.extract(F.lit("SECOND"), ts))
    return ts - past


def time_bucket(ts: Column, minutes: int = 15) -> Column:
    """Start of the bar that holds ``ts``, as ``cut_minutes``; a window is the same and cheaper where
    the width divides the hour."""
    return F.window(ts, f"{minutes} minutes").start if 60 % minutes == 0 else cut_minutes(ts, minutes)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Every dim_date column that follows from the bar start alone."""
    date = ts.cast("date")
    dow = F.dayofweek(ts) - 1
    day = F.dayofmonth(ts)
    month = F.month(ts)
    clock = F.hour(ts) * 60 + F.minute(ts)
    # Fixed rules: Friday after Thanksgiving, Christmas Eve, July 3rd
    short_day = (
        ((month == 11) & day.between(23, 29) & (dow == 5))
        | ((month == 12) & (day == 24))
        | ((month == 7) & (day == 3))
    )
    closed_early = short_day & (clock >= 13 * 60)
    return {
        "sk_date_id": smart_key(ts),
        "datetime": ts,
        "date": date,
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "second": F.second(ts),
        "day_of_week": dow,
        "day_name": F.date_format(date, "EEEE"),
        "day_of_month": day,
        "day_of_year": F.dayofyear(ts),
        "week_of_month": F.ceil(day / 7).cast("int"),
        "week_of_year": F.weekofyear(ts),
        "month": month,
        "month_name": F.date_format(date, "MMMM"),
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "is_weekend": dow.isin(0, 6),
        "is_holiday": F.lit(False),
        "fiscal_year": F.year(ts),
        "fiscal_quarter": F.quarter(ts),
        "is_pre_market": clock < 9 * 60 + 30,
        "is_regular_session": ~closed_early & clock.between(9 * 60 + 30, 16 * 60),
        "is_after_hours": closed_early | (clock > 16 * 60),
        "is_early_close": closed_early,
    }
