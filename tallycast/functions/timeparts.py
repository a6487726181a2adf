"""Time buckets and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def time_bucket(ts: Column | str, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket since the epoch (floor)."""
    return F.floor(F.unix_seconds(_col(ts)) / F.lit(seconds))


def utc_day(ts: Column | str) -> Column:
    """Calendar day in UTC, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_col(ts)) / F.lit(86400)).cast("int"))


def local_time(ts: Column | str, tz: str | None) -> Column:
    """Wall-clock time in ``tz``; unchanged (session zone) when ``tz`` is None."""
    if tz is None:
        return _col(ts)
    return F.convert_timezone(None, F.lit(tz), _col(ts).cast("timestamp_ntz"))


def clock_hour(ts: Column | str) -> Column:
    """Hour 1-24, midnight is 24."""
    hour = F.hour(_col(ts))
    return F.when(hour == 0, F.lit(24)).otherwise(hour)


def weekday_name(ts: Column | str) -> Column:
    """``Mon`` .. ``Sun``."""
    return F.date_format(_col(ts), "E")


def calendar_parts(ts: Column | str, tz: str | None = None) -> dict[str, Column]:
    """``hour`` (1-24), ``month``, ``weekday``, ``year`` and ``day_of_year``."""
    when = local_time(ts, tz)
    return {
        "hour": clock_hour(when),
        "month": F.month(when),
        "weekday": weekday_name(when),
        "year": F.year(when),
        "day_of_year": F.dayofyear(when),
    }
