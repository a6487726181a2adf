"""Events against weather readings: by time bucket and by collection run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.timeparts import time_bucket
from tallycast.operators.summarize import summarize, zero_filled_count

# ---- fixed values: bucket width, lateness tolerance, averaged and voted columns
BUCKET_SECONDS = 900
TOLERANCE_SECONDS = 300
WEATHER_MEANS = ("humidity", "pressure", "temperature", "wind_speed")
WEATHER_MODES = ("weather_type", "wind_direction")

#: What identifies a reading. Kept in one order everywhere, so that steps hashed on
#: these columns share their partitioning.
RUN_KEYS = ("city_name", "scheduler_id")

_BUCKET, _KEY = "time_interval", "__key"


def bucket_weather(
    readings: DataFrame,
    keys: Sequence[str] = ("city_name",),
    ts: str = "date",
    seconds: int = BUCKET_SECONDS,
    means: Sequence[str] = WEATHER_MEANS,
    modes: Sequence[str] = WEATHER_MODES,
) -> DataFrame:
    """One row per (time bucket, keys): means of numbers, most frequent categories."""
    bucketed = readings.select(time_bucket(ts, seconds).alias(_BUCKET), *keys, *means, *modes)
    return summarize(bucketed, [_BUCKET, *keys], means=means, modes=modes)


def bucket_join(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str] = ("city_name",),
    ts: str = "date",
    seconds: int = BUCKET_SECONDS,
    means: Sequence[str] = WEATHER_MEANS,
    modes: Sequence[str] = WEATHER_MODES,
) -> DataFrame:
    """Every event with the weather of its own bucket; events without any are left out.

    The weather side comes out of an aggregation on the join keys, whose partitions
    AQE may not split. Joining on one struct of the keys gives that side a shuffle of
    its own, so AQE splits a hot bucket by itself. Rows with a NULL key match nothing
    and are dropped first: structs of NULLs would be equal.
    """
    weather = bucket_weather(readings, keys, ts, seconds, means, modes)
    kept = [name for name in events.columns if name != "scheduler_id"]
    placed = events.select(*kept).withColumn(_BUCKET, time_bucket(ts, seconds))
    key = F.struct(_BUCKET, *keys).alias(_KEY)
    sides = [side.dropna(subset=[_BUCKET, *keys]) for side in (placed, weather)]
    joined = sides[0].select(*kept, key).join(sides[1].select(*means, *modes, key), _KEY)
    return joined.select(*kept, *means, *modes)


def earliest(readings: DataFrame, ts: str = "date") -> Column:
    """Smallest ``ts`` as a scalar subquery; NULL when there are no readings."""
    return readings.select(F.min(ts)).scalar()


def drop_late(
    events: DataFrame, first_reading: Column, tolerance: int = TOLERANCE_SECONDS, ts: str = "date"
) -> DataFrame:
    """Events less than ``tolerance`` seconds older than the first reading.

    The bound is strict. Without readings nothing is kept.
    """
    return events.filter(F.col(ts) > first_reading - F.expr(f"INTERVAL {int(tolerance)} SECONDS"))


def count_per_run(
    readings: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = RUN_KEYS,
    tolerance: int = TOLERANCE_SECONDS,
    first_reading: Column | None = None,
    count_name: str = "crashes",
    ts: str = "date",
) -> DataFrame:
    """Each reading with the number of events of its run, 0 where there are none.

    ``readings`` must be unique per ``keys``. ``first_reading`` saves scanning
    ``readings`` twice when the caller has a cheaper source for that minimum.
    """
    bound = earliest(readings, ts) if first_reading is None else first_reading
    counted = zero_filled_count(readings, drop_late(events, bound, tolerance, ts), keys, count_name)
    measures = [name for name in readings.columns if name not in (*keys, ts)]
    return counted.select(keys[0], count_name, ts, *measures)
