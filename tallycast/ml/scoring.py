"""Readings -> predicted crashes of the next hour."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tallycast.operators.rollup import add_calendar
from tallycast.operators.serve import prediction_rows


def score(model: PipelineModel, readings: DataFrame, tz: str | None = None) -> DataFrame:
    """Prediction rows for clean weather ``readings``."""
    return prediction_rows(model.transform(add_calendar(readings, "date", tz)))
