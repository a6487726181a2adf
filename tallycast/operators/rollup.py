"""Run counts -> hourly features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.timeparts import calendar_parts
from tallycast.operators.align import WEATHER_MEANS, WEATHER_MODES
from tallycast.operators.summarize import summarize


def add_calendar(
    df: DataFrame,
    ts: str = "date",
    tz: str | None = None,
    parts: Sequence[str] = ("hour", "month", "weekday"),
) -> DataFrame:
    """Add calendar columns of ``ts`` as seen in ``tz``."""
    wanted = calendar_parts(ts, tz)
    return df.withColumns({name: wanted[name] for name in parts})


def calendar_rollup(
    df: DataFrame,
    keys: Sequence[str] = ("city_name",),
    ts: str = "date",
    sums: Sequence[str] = ("crashes",),
    means: Sequence[str] = WEATHER_MEANS,
    modes: Sequence[str] = WEATHER_MODES,
    by_year: bool = True,
    tz: str | None = None,
    keep_day: bool = False,
) -> DataFrame:
    """One row per (keys, day, hour 1-24).

    ``by_year=False`` merges the same day of different years; the month and weekday
    shown are then the lowest. ``keep_day`` keeps the day columns, which identify a
    row.
    """
    day = ["year", "day_of_year"] if by_year else ["day_of_year"]
    dated = add_calendar(df, ts, tz, ["hour", "month", "weekday", *day])
    rolled = summarize(dated, [*keys, *day, "hour"], means=means, modes=modes, sums=sums, mins=["month", "weekday"])
    shown = [*keys, "hour", *sums, *means, "month", "weekday", *modes]
    return rolled.select(*shown, *(day if keep_day else []))
