"""Event arrays delivered as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast import schemas

# ---- fixed value: the event type that is collected
CRASH = "crash"


def explode_typed_events(
    df: DataFrame,
    body: str = "body",
    event_type: str = CRASH,
    schema: T.StructType = schemas.RAW_EVENT,
) -> DataFrame:
    """One row per event of ``event_type`` in the JSON array ``body``.

    Other columns of ``df`` (city, run) are repeated on each event. Unwanted events
    are removed inside the array, before rows are made of it.
    """
    others = [name for name in df.columns if name != body]
    wanted = F.filter(F.from_json(body, T.ArrayType(schema)), lambda event: event["type"] == event_type)
    return df.select(*others, F.inline(wanted))
