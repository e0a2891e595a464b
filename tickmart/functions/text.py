"""Column expressions on landed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbols that are not stocks.
BONDS = ("IRX", "FVX", "TNX")
INDICES = ("DJI", "IXIC", "GSPC")
COMMODITIES = ("GCF", "CLF")

TIMEZONE_LABEL = "America/New_York"


def canonical_symbol(symbol: Column) -> Column:
    """One join key for every spelling of a symbol (``BF_B``, ``BF-B``, ``BF.B``)."""
    # ASCII letters and digits stay; Java takes twenty times as long over [^A-Za-z0-9], which is the same
    return F.lower(F.regexp_replace(symbol, r"\P{Alnum}", ""))


def api_symbol(symbol: Column) -> Column:
    """The spelling profile files use."""
    return F.translate(symbol, "_", "-")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def to_price(text: Column) -> Column:
    return blank_to_null(text).try_cast("decimal(18,6)")


# The accepted forms, upper case; a time may be left out (midnight), as may seconds and fractions.
DAYS = (r"\d{4}-\d{1,2}-\d{1,2}", r"\d{1,2}/\d{1,2}/\d{4}")
#: The usual form, which Spark reads as it is.
PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?$"
PAST_HOUR = r":\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
CLOCK = rf"(?:[ T]+(?:\d{{1,2}}{PAST_HOUR} *|(?:0?[1-9]|1[0-2]){PAST_HOUR} *[AP]M))?"


def to_trade_date(text: Column) -> Column:
    """Wall-clock time of ``2024-01-02``, ``2024-01-02 09:30``, ``2024-01-02T09:30:15.5``,
    ``01/02/2024 9:30 am`` (month first) and mixtures of these; anything else is NULL, as is a date
    or time that does not exist.

    Short on purpose: the JVM compiles no method of over 8,000 bytes, and this is one with what else is
    read from a row.
    """
    text = F.upper(F.trim(text))
    year_first = F.regexp_replace(text, r"^(\d+)/(\d+)/(\d+)", "$3-$1-$2")
    at = F.regexp_replace(year_first, r"(?s)^([\d-]+)(?:[ T]+([\d:.]+))?.*", "$1 $2")
    # of twelve hours: 12 is the first, and those of the second half come 12 later
    later = F.when(text.contains("PM"), 12).otherwise(0) - F.when(text.contains("M") & at.contains(" 12:"), 12).otherwise(0)
    # the second branch is not computed for rows of the first
    return (
        F.when(text.rlike(PLAIN), text.try_cast("timestamp_ntz"))
        .when(text.rlike(f"^(?:{'|'.join(DAYS)}){CLOCK}$"), at.try_cast("timestamp_ntz") + F.make_dt_interval(hours=later))
    )


def to_volume(text: Column) -> Column:
    """Whole part of the text: ``2.9`` is 2 - cut, not rounded."""
    return F.nullif(F.split_part(F.trim(text), F.lit("."), F.lit(1)), F.lit("")).try_cast("bigint")


def classify_symbol(symbol: Column) -> Column:
    kinds = {"bond": BONDS, "index": INDICES, "commodity": COMMODITIES}
    known = F.create_map(*[F.lit(text) for kind, keys in kinds.items() for key in keys for text in (key, kind)])
    return F.coalesce(F.try_element_at(known, F.upper(canonical_symbol(symbol))), F.lit("stock"))


def audit_hash(symbol: Column, date: Column, close: Column) -> Column:
    # concat_ws skips NULL parts where concat would turn the whole text NULL
    return F.md5(F.concat_ws("", symbol, F.trim(date), F.nullif(close, F.lit(""))))
