"""Notifications -> the stored records they point at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCHED = "matched"


def look_up(messages: DataFrame, records: DataFrame, message_key: str = "cache_id", record_key: str = "key") -> DataFrame:
    """Every message with the fields of its record, NULL without one, and ``matched``.

    ``records`` is unique per key. A repeated message repeats its record. One left
    join of two plain inputs: AQE splits a key that holds most of the messages.
    """
    keyed = records.withColumnRenamed(record_key, message_key).withColumn(MATCHED, F.lit(True))
    fields = [name for name in keyed.columns if name not in (message_key, MATCHED)]
    joined = messages.join(keyed, message_key, "left")
    return joined.select(*messages.columns, *fields, F.coalesce(MATCHED, F.lit(False)).alias(MATCHED))


def lookup_records(
    messages: DataFrame, records: DataFrame, message_key: str = "cache_id", record_key: str = "key"
) -> tuple[DataFrame, DataFrame]:
    """``(found, missing)``: messages with their record, and messages without one."""
    joined = look_up(messages, records, message_key, record_key)
    return joined.filter(MATCHED).drop(MATCHED), joined.filter(~F.col(MATCHED)).select(*messages.columns)
