"""Readings scraped as text -> typed values. Unreadable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A date comes first; a time of day alone would be read as one of today.
_DATED = r"^\s*[+-]?\d{4,6}(?:-|\s*$)"
#: A zone can only follow a time of day; what ends a bare date is its day.
_ZONED = (
    r"[T ]\d{1,2}(?::\d{1,2}){0,2}(?:\.\d*)?\s*"
    r"(?:[Zz]|(?:UTC|GMT|UT)?[+-]\d{1,2}(?::?\d{2}){0,2}|UTC|GMT|UT|[A-Za-z_]+(?:/[A-Za-z_+-]+){1,3})\s*$"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def percent_to_ratio(text: Column | str) -> Column:
    """``'87%'`` -> 0.87."""
    return F.regexp_replace(_col(text), "%", "").try_cast("float") / F.lit(100)


def first_integer(text: Column | str) -> Column:
    """First run of digits: ``'745 mm'`` -> 745."""
    return F.regexp_extract(_col(text), r"(\d+)", 1).try_cast("int")


def signed_integer(text: Column | str) -> Column:
    """Whole number that may carry the typographic minus U+2212."""
    return F.translate(_col(text), "−", "-").try_cast("int")


def comma_decimal(text: Column | str) -> Column:
    """``'3,5'`` -> 3.5."""
    return F.translate(_col(text), ",", ".").try_cast("float")


def iso_time(text: Column | str, tz: str = "UTC") -> Column:
    """ISO date or date-time text -> timestamp, as a cast reads it; NULL if it cannot.

    Seconds, minutes, the fraction and the zone may be missing. ``tz`` is the zone of
    text that names none. It is written into the text, so the result does not depend
    on the session time zone.
    """
    text = _col(text)
    local = F.date_format(text.try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    zoned = F.when(text.rlike(_ZONED), text).otherwise(F.concat(local, F.lit(f" {tz}")))
    return F.when(text.rlike(_DATED), F.try_to_timestamp(zoned))


def epoch_or_iso_time(text: Column | str, tz: str = "UTC") -> Column:
    """Event time given as epoch seconds (number or digits) or as ISO text."""
    text = _col(text).cast("string")
    seconds = F.timestamp_seconds(text.try_cast("decimal(18,6)"))
    return F.coalesce(seconds, iso_time(text, tz))
