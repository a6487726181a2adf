"""Raw collected records -> typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.functions import text
from tallycast.operators.align import RUN_KEYS
from tallycast.operators.dedup import keep_first


def flatten_events(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """Nested feed events -> ``CLEAN_EVENT`` columns. Coordinates are lon, lat."""
    raw = schemas.conform(df, schemas.RUN_EVENT)
    point = F.col("location.coordinates")
    flat = raw.select(
        "id",
        F.get(point, 1).alias("latitude"),
        F.get(point, 0).alias("longitude"),
        F.col("feedbacks.dislikes").alias("dislikes"),
        F.col("feedbacks.likes").alias("likes"),
        text.epoch_or_iso_time("timestamp", tz).alias("date"),
        "city_name",
        "scheduler_id",
    )
    return schemas.conform(flat, schemas.CLEAN_EVENT)


def clean_events(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """:func:`flatten_events`, one row per event id (earliest)."""
    return keep_first(flatten_events(df, tz), ["id"], ["date", "scheduler_id"])


def type_weather(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """Text readings -> ``CLEAN_WEATHER`` columns; ``tz`` is for zoneless times."""
    raw = schemas.conform(df, schemas.RUN_WEATHER)
    typed = raw.select(
        text.percent_to_ratio("humidity").alias("humidity"),
        text.first_integer("pressure").alias("pressure"),
        text.signed_integer("temperature").alias("temperature"),
        "weather_type",
        "wind_direction",
        text.comma_decimal("wind_speed").alias("wind_speed"),
        text.iso_time("datetime", tz).alias("date"),
        "city_name",
        "scheduler_id",
    )
    return schemas.conform(typed, schemas.CLEAN_WEATHER)


def clean_weather(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """:func:`type_weather`, one reading per (city, run) (earliest)."""
    return keep_first(type_weather(df, tz), list(RUN_KEYS), [F.col("date").asc_nulls_last()])
