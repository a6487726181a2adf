"""Reading side of the prediction table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.functions.timeparts import local_time, utc_day
from tallycast.functions.wording import CITY_LABELS, DISPLAY_TIME, crash_word, label_of
from tallycast.operators.summarize import any_contains

# ---- fixed values: how long predictions stay listed, and for how long each holds
LISTED_DAYS = 10
VALID_HOURS = 1

DISPLAY_COLUMNS = ("city", "crashes", "startDate", "endDate")

#: Partition column of the stored table, the day of ``endDate`` in UTC.
END_DAY = "end_day"


def prediction_rows(
    scored: DataFrame, city: str = "city_name", prediction: str = "prediction", ts: str = "date"
) -> DataFrame:
    """Scored readings -> predictions: count rounded half up, valid from ``ts`` on."""
    rows = scored.select(
        F.col(city).alias("city"),
        F.round(prediction).cast("int").alias("crashes"),
        F.col(ts).alias("startDate"),
        (F.col(ts) + F.expr(f"INTERVAL {VALID_HOURS} HOUR")).alias("endDate"),
    )
    return schemas.conform(rows, schemas.PREDICTION)


def end_day(end: Column) -> Column:
    """Value of :data:`END_DAY` for an end time, whatever the session zone."""
    return utc_day(end)


def recent_predictions(
    predictions: DataFrame, as_of: datetime | Column | None = None, days: int = LISTED_DAYS
) -> DataFrame:
    """Predictions that ended in ``[as_of - days, as_of)``, latest first."""
    if as_of is None:
        as_of = F.current_timestamp()
    until = as_of if isinstance(as_of, Column) else F.lit(as_of)
    since = until - F.expr(f"INTERVAL {int(days)} DAYS")
    end = F.col("endDate")
    listed = predictions.filter((end >= since) & (end < until))
    if END_DAY in predictions.columns:  # prune partitions of the stored table
        listed = listed.filter(F.col(END_DAY).between(end_day(since), end_day(until)))
    return listed.orderBy(F.desc("endDate"), "city", "startDate", "crashes")


def display_predictions(
    predictions: DataFrame,
    labels: Mapping[str, str] = CITY_LABELS,
    compat: bool = False,
    tz: str | None = None,
) -> DataFrame:
    """Predictions as shown: labelled city, count with its noun, formatted times."""
    def shown(ts: str) -> Column:
        return F.date_format(local_time(ts, tz), DISPLAY_TIME).alias(ts)

    counted = F.concat_ws(" ", F.col("crashes").cast("string"), crash_word(F.col("crashes"), compat))
    return predictions.select(
        label_of(F.col("city"), labels).alias("city"),
        counted.alias("crashes"),
        shown("startDate"),
        shown("endDate"),
    )


def search_any(df: DataFrame, term: str, columns: Sequence[str] = DISPLAY_COLUMNS) -> DataFrame:
    """Rows with ``term`` in any of ``columns``; case and outer blanks do not count."""
    needle = term.strip().lower()
    return df.filter(any_contains([F.col(c) for c in columns], needle)) if needle else df
