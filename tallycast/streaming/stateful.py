"""Continuous forms with watermarked state.

Watermarks bound state and differ from the batch lateness rule: they trail the
newest event time, while the batch rule looks at the earliest reading. Rows that
come later than the delay are lost here, so files have to land in time order or the
delay has to cover the disorder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallycast.ml.registry import ModelStore
from tallycast.ml.scoring import score
from tallycast.operators.align import BUCKET_SECONDS, TOLERANCE_SECONDS, WEATHER_MEANS, WEATHER_MODES
from tallycast.operators.clean import type_weather
from tallycast.operators.serve import END_DAY, end_day
from tallycast.streaming.runs import append_files, begin

DELAY = f"{TOLERANCE_SECONDS} seconds"
WIDTH = f"{BUCKET_SECONDS} seconds"

_MICROS, _SALT = "__micros", "__salt"


def stateful_dedup(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row per key over the life of the stream; every key is remembered for good.

    Where keys have to be forgotten, or many copies of one come, use
    :func:`tallycast.streaming.microbatch.remember_first_sightings`.
    """
    return stream.dropDuplicates(list(keys))


def bucket_weather_stream(
    readings: DataFrame,
    keys: Sequence[str] = ("city_name",),
    ts: str = "date",
    width: str = WIDTH,
    delay: str = DELAY,
    means: Sequence[str] = WEATHER_MEANS,
    modes: Sequence[str] = WEATHER_MODES,
) -> DataFrame:
    """Readings per (window, keys). In append mode a window comes out once closed.

    Partial aggregation runs ahead of the shuffle. State holds, per open window,
    running sums and the counts of each category.
    """
    return (
        readings.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), *keys)
        .agg(*[F.avg(c).alias(c) for c in means], *[F.mode(c, True).alias(c) for c in modes])
    )


def bucket_join_stream(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str] = ("city_name",),
    ts: str = "date",
    width: str = WIDTH,
    delay: str = DELAY,
    slices: int = 8,
) -> DataFrame:
    """Events with the weather of their window, once that window has closed.

    AQE does not split stateful joins, so events of one window and city are spread
    over ``slices`` by a hash of their content and the few weather rows are copied.
    """
    weather = bucket_weather_stream(readings, keys, ts, width, delay).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint")))
    )
    kept = [name for name in events.columns if name not in (ts, "scheduler_id")]
    content = F.xxhash64(*[F.col(name) for name in [ts, *kept]])
    placed = events.withWatermark(ts, delay).select(
        *kept,
        F.unix_micros(ts).alias(_MICROS),  # a second event-time column is not allowed
        F.window(ts, width).alias("window"),
        F.pmod(content, F.lit(slices)).alias(_SALT),
    )
    joined = placed.join(weather, ["window", *keys, _SALT])
    return joined.select(*kept, F.timestamp_micros(_MICROS).alias(ts), *WEATHER_MEANS, *WEATHER_MODES)


def predictions_stream(model: PipelineModel, raw_readings: DataFrame, tz: str = "UTC", model_tz: str | None = None) -> DataFrame:
    """Text readings -> prediction rows with their partition column; no state.

    ``tz`` is the zone of times that name none, ``model_tz`` the zone of the calendar parts
    that the model was trained on. :class:`~tallycast.streaming.scoring.ScoringTick` also
    counts the readings and scores a repeated run once.
    """
    predicted = score(model, type_weather(raw_readings, tz), model_tz)
    return predicted.withColumn(END_DAY, end_day(F.col("endDate")))


def start_scoring(
    store: ModelStore, raw_readings: DataFrame, out: str, checkpoint: str, every: str | None = None, tz: str = "UTC"
) -> StreamingQuery | None:
    """Score new readings with the current model; without a model, do nothing.

    Calendar parts are taken in the zone stored with the model.
    """
    if not store.exists():
        return None
    predicted = predictions_stream(store.load(), raw_readings, tz, store.zone())
    return begin(append_files(predicted, out, (END_DAY,)), checkpoint, every)
