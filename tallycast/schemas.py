"""Declared schema of every logical table.

Readers apply these, so an absent field is a NULL column and an empty input has
the same columns, types and order as a full one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _real, _whole, _time = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

# ---- fixed values: the two record kinds a collector lands
TRAFFIC_KIND = "traffic_events"
WEATHER_KIND = "weather_forecast"

NOTIFICATION = _struct(schedule_id=_text, cache_id=_text, crawler_type=_text)

# `timestamp` is epoch seconds or text in the feed. Text keeps either one whole.
RAW_EVENT = _struct(
    id=_text,
    type=_text,
    location=_struct(coordinates=T.ArrayType(_real)),
    feedbacks=_struct(likes=_whole, dislikes=_whole),
    timestamp=_text,
)

TRAFFIC_PAYLOAD = _struct(city_name=_text, events=T.ArrayType(RAW_EVENT))

RAW_WEATHER = _struct(
    temperature=_text,
    weather_type=_text,
    temperature_feelings=_text,
    wind_speed=_text,
    wind_direction=_text,
    humidity=_text,
    pressure=_text,
    water_temperature=_text,
    datetime=_text,
    city_name=_text,
)

#: Payload of either kind; fields of the other kind read as NULL.
ANY_PAYLOAD = T.StructType([*RAW_WEATHER.fields, T.StructField("events", T.ArrayType(RAW_EVENT))])

PAYLOADS = {TRAFFIC_KIND: TRAFFIC_PAYLOAD, WEATHER_KIND: RAW_WEATHER, None: ANY_PAYLOAD}

RUN_EVENT = T.StructType(
    [*RAW_EVENT.fields, T.StructField("city_name", _text), T.StructField("scheduler_id", _text)]
)
RUN_WEATHER = T.StructType([*RAW_WEATHER.fields, T.StructField("scheduler_id", _text)])

CLEAN_EVENT = _struct(
    id=_text,
    latitude=_real,
    longitude=_real,
    dislikes=_whole,
    likes=_whole,
    date=_time,
    city_name=_text,
    scheduler_id=_text,
)

CLEAN_WEATHER = _struct(
    humidity=_real,
    pressure=T.IntegerType(),
    temperature=T.IntegerType(),
    weather_type=_text,
    wind_direction=_text,
    wind_speed=T.FloatType(),
    date=_time,
    city_name=_text,
    scheduler_id=_text,
)

RUN_COUNT = _struct(
    city_name=_text,
    crashes=_whole,
    date=_time,
    humidity=_real,
    pressure=T.IntegerType(),
    temperature=T.IntegerType(),
    weather_type=_text,
    wind_direction=_text,
    wind_speed=T.FloatType(),
)

PREDICTION = _struct(city=_text, crashes=T.IntegerType(), startDate=_time, endDate=_time)


def envelope(kind: str | None = None) -> T.StructType:
    """Landing envelope around the payload of ``kind`` (any payload when None)."""
    return _struct(scheduler_id=_text, crawler_type=_text, data=PAYLOADS[kind])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed frame without rows."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; others are dropped, absent ones NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (df[field.name] if field.name in have else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
    )
