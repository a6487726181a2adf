"""Landed collector output: one JSON envelope per city, kind and run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast import schemas
from tallycast.operators.dedup import keep_first

LANDED_AT, LANDED_FILE, LANDED_TEXT = "landed_at", "landed_file", "landed_text"


def read_landing(
    spark: SparkSession, path: str, kind: str | None = None, streaming: bool = False, **options
) -> DataFrame:
    """Envelopes below ``path`` with the file each came from and its time.

    ``kind=None`` reads both kinds with a payload schema that covers either, and also the
    lines that are no JSON object, as ``landed_text`` (see :func:`unreadable`). A document
    of several lines needs ``multiLine=True`` among the ``options``.
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    shape = schemas.envelope(kind).add(LANDED_TEXT, T.StringType())
    envelopes = reader.schema(shape).option("columnNameOfCorruptRecord", LANDED_TEXT).json(path)
    stamped = envelopes.select(
        "*",
        F.col("_metadata.file_modification_time").alias(LANDED_AT),
        F.col("_metadata.file_path").alias(LANDED_FILE),
    )
    return stamped if kind is None else only_kind(stamped, kind)


def unreadable(envelopes: DataFrame) -> DataFrame:
    """What could not be read as an envelope, with its file: to be counted, not lost."""
    broken = envelopes.filter(F.col(LANDED_TEXT).isNotNull())
    return broken.select(LANDED_TEXT, LANDED_AT, LANDED_FILE)


def only_kind(envelopes: DataFrame, kind: str) -> DataFrame:
    """Envelopes of one kind, payload narrowed to its fields; other kinds are ignored."""
    payload = schemas.PAYLOADS[kind]
    fields = F.struct(*[F.col(f"data.{name}").alias(name) for name in payload.names])
    return envelopes.filter(F.col("crawler_type") == kind).withColumn("data", fields)


def record_key() -> Column:
    """Storage key of an envelope, ``kind:city:run``."""
    return F.concat_ws(":", "crawler_type", "data.city_name", "scheduler_id")


def latest_per_key(envelopes: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Envelopes with their ``key``; collecting a run again replaces what it landed."""
    newest = [F.desc(LANDED_AT), F.desc(LANDED_FILE)] if order is None else list(order)
    return keep_first(envelopes.withColumn("key", record_key()), ["key"], newest)


def weather_records(envelopes: DataFrame) -> DataFrame:
    """Payload of weather envelopes with the run id."""
    readings = only_kind(envelopes, schemas.WEATHER_KIND).select("data.*", "scheduler_id")
    return schemas.conform(readings, schemas.RUN_WEATHER)


def traffic_records(envelopes: DataFrame) -> DataFrame:
    """One row per event of traffic envelopes, with city, run and landing columns."""
    landed = [name for name in (LANDED_AT, LANDED_FILE) if name in envelopes.columns]
    events = only_kind(envelopes, schemas.TRAFFIC_KIND).select(
        F.inline("data.events"), F.col("data.city_name").alias("city_name"), "scheduler_id", *landed
    )
    return events.select(*schemas.RUN_EVENT.names, *landed)


def write_landing(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Write envelopes as JSON lines."""
    envelopes.select("scheduler_id", "crawler_type", "data").write.mode(mode).json(path)


def records_to_frame(spark: SparkSession, records: Sequence[dict], schema: T.StructType) -> DataFrame:
    """In-memory records -> frame, matched by field name; absent fields are NULL.

    For the handful of records one collection tick hands over. Stored data is read
    with :func:`read_landing`.
    """
    return spark.createDataFrame([{name: r.get(name) for name in schema.names} for r in records], schema)
