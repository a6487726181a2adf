"""Views that give the given tables the shape of collected city data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.operators.align import RUN_KEYS
from tallycast.operators.dedup import keep_first

#: Each of the five types of the table stands for one kind of record.
TRAFFIC_TYPES, READING_TYPES = ("error", "purchase", "signup"), ("click", "view")
WEATHER_TYPES = ("clear", "cloudy", "rain", "snow")
WIND_DIRECTIONS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with its zoneless time read as UTC."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; the pattern lets it be one file or a folder."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(number, F.lit(len(values))).cast("int"))


def _per(number: Column, base: int, divisor: float) -> Column:
    return (number % base).cast("double") / F.lit(divisor)


def _common() -> list[Column]:
    return [
        F.when(F.col("user_id") % 2 == 0, "msc").otherwise("spb").alias("city_name"),
        _run(F.col("ts")).alias("scheduler_id"),
        F.col("ts").alias("date"),
    ]


def _run(ts: Column) -> Column:
    """Id of the collection run a time falls in: the hour since the epoch."""
    return F.floor(F.unix_seconds(ts) / F.lit(3600)).cast("string")


def traffic(source: DataFrame) -> DataFrame:
    """Clean traffic events, from the rows of types ``TRAFFIC_TYPES``."""
    number = F.col("event_id")
    return source.filter(F.col("event_type").isin(*TRAFFIC_TYPES)).select(
        number.cast("string").alias("id"),
        *_common(),
        (number % 7).alias("likes"),
        (number % 3).alias("dislikes"),
        (F.lit(30.0) + _per(F.col("user_id"), 10, 10.0)).alias("longitude"),
        (F.lit(55.0) + _per(F.col("user_id"), 10, 10.0)).alias("latitude"),
    )


def traffic_repeated(source: DataFrame) -> DataFrame:
    """:func:`traffic` with every tenth event collected again one run later."""
    number = F.col("id").cast("bigint")
    once = traffic(source).withColumn("collected_at", F.col("date"))
    later = once.filter(number % 10 == 0).withColumn("collected_at", F.col("date") + F.expr("INTERVAL 1 HOUR"))
    again = later.withColumn("scheduler_id", _run(F.col("collected_at")))
    return once.unionByName(again)


def weather(source: DataFrame) -> DataFrame:
    """Clean weather readings, from the rows of types ``READING_TYPES``."""
    number, user = F.col("event_id"), F.col("user_id")
    return source.filter(F.col("event_type").isin(*READING_TYPES)).select(
        number,
        *_common(),
        _per(number, 100, 100.0).alias("humidity"),
        (F.lit(730) + number % 40).cast("int").alias("pressure"),
        (number % 41 - 20).cast("int").alias("temperature"),
        _per(number, 150, 10.0).alias("wind_speed"),
        _pick(WEATHER_TYPES, user).alias("weather_type"),
        _pick(WIND_DIRECTIONS, user).alias("wind_direction"),
    )


def weather_text(source: DataFrame, malformed: bool = True) -> DataFrame:
    """:func:`weather` as scraped text; with ``malformed`` every 50th row is broken."""
    number = F.col("event_id")
    broken = (number % 50 == 0) if malformed else F.lit(False)
    moscow = F.col("date") + F.expr("INTERVAL 3 HOURS")
    with_fraction = F.date_format(moscow, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    without = F.date_format(moscow, "yyyy-MM-dd'T'HH:mm:ss")
    return weather(source).select(
        "event_id",
        F.translate(F.col("temperature").cast("string"), "-", "−").alias("temperature"),
        "weather_type",
        F.lit(None).cast("string").alias("temperature_feelings"),
        F.translate(F.format_string("%.1f", "wind_speed"), ".", ",").alias("wind_speed"),
        "wind_direction",
        F.when(broken, "n/a").otherwise(F.concat((number % 100).cast("string"), F.lit("%"))).alias("humidity"),
        F.when(broken, "").otherwise(F.concat(F.col("pressure").cast("string"), F.lit(" mm"))).alias("pressure"),
        F.lit(None).cast("string").alias("water_temperature"),
        F.concat(F.when(broken, without).otherwise(with_fraction), F.lit("+03:00")).alias("datetime"),
        "city_name",
        "scheduler_id",
    )


def raw_events(source: DataFrame) -> DataFrame:
    """:func:`traffic` in the nested shape of the feed, times as epoch seconds."""
    return traffic(source).select(
        "id",
        F.lit("crash").alias("type"),
        F.struct(F.array("longitude", "latitude").alias("coordinates")).alias("location"),
        F.struct("likes", "dislikes").alias("feedbacks"),
        (F.unix_micros("date").cast("decimal(18,0)") / F.lit(1000000).cast("decimal(8,0)"))
        .cast("decimal(18,6)").cast("string").alias("timestamp"),
        "city_name",
        "scheduler_id",
    )


def traffic_envelopes(source: DataFrame) -> DataFrame:
    """Landing envelopes of :func:`raw_events`, one event each."""
    event = F.struct(*[F.col(name) for name in schemas.RAW_EVENT.names])
    data = F.struct("city_name", F.array(event).alias("events"))
    kind = F.lit(schemas.TRAFFIC_KIND).alias("crawler_type")
    return raw_events(source).select("scheduler_id", kind, data.alias("data"))


def weather_envelopes(source: DataFrame, malformed: bool = True) -> DataFrame:
    """Landing envelopes of :func:`weather_text`."""
    data = F.struct(*[F.col(name) for name in schemas.RAW_WEATHER.names])
    return weather_text(source, malformed).select(
        "scheduler_id", F.lit(schemas.WEATHER_KIND).alias("crawler_type"), data.alias("data")
    )


def predictions(source: DataFrame) -> DataFrame:
    """Prediction rows, one per first reading of a (run, city)."""
    first = keep_first(weather(source), RUN_KEYS, ["date", "event_id"])
    return schemas.conform(
        first.select(
            F.col("city_name").alias("city"),
            (F.col("event_id") % 25).alias("crashes"),
            F.col("date").alias("startDate"),
            (F.col("date") + F.expr("INTERVAL 1 HOUR")).alias("endDate"),
        ),
        schemas.PREDICTION,
    )
