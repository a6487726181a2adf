"""The three periodic jobs and the listing, over stored tables.

Run as::

    python -m tallycast.plans.jobs process --landing L --out O --seen S --checkpoint C
    python -m tallycast.plans.jobs train   --counts O/run_count --models M
    python -m tallycast.plans.jobs predict --landing R --models M --predictions P --checkpoint D
    python -m tallycast.plans.jobs list    --predictions P
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallycast import schemas
from tallycast.ml.registry import ModelStore
from tallycast.ml.training import train_forest
from tallycast.operators import serve
from tallycast.operators.rollup import calendar_rollup
from tallycast.session import build_session, cut_lineage
from tallycast.sources import landing, tables
from tallycast.streaming.microbatch import Tick
from tallycast.streaming.runs import drain
from tallycast.streaming.scoring import ScoringTick


def process(
    spark: SparkSession,
    landed: str,
    out: str,
    seen: str,
    checkpoint: str,
    tz: str = "UTC",
    every: str | None = None,
    **settings,
) -> Tick:
    """Work off everything landed since the last call, or go on at an interval.

    ``settings`` go to the tick.
    """
    tick = Tick(out, tables.SeenIds(spark, seen), tz, **settings)
    drain(tick.start(landing.read_landing(spark, landed, streaming=True), checkpoint, every))
    return tick


def train(spark: SparkSession, counts: DataFrame, models: str, tz: str | None = None, **tuning) -> int:
    """Train on run counts; 0, 1 or -1 as the model was first, better or not kept."""
    hourly = cut_lineage(calendar_rollup(counts, tz=tz, keep_day=True))
    trained = train_forest(hourly, **tuning)
    return ModelStore(spark, models).promote_if_better(trained.model, trained.held_out, tz=tz)


def predict(
    spark: SparkSession,
    landed: str,
    models: str,
    predictions: str,
    checkpoint: str,
    tz: str = "UTC",
    every: str | None = None,
    keep_days: int = 30,
) -> dict[str, int] | None:
    """Score the readings landed since the last call and store the predictions.

    A run that is collected again within ``keep_days`` days is scored once, its newest copy
    if both come together. Returns how many readings there were and how many lack a number
    and were left out; None when there is no model.
    """
    store = ModelStore(spark, models)
    if not store.exists():
        return None
    envelopes = landing.read_landing(spark, landed, schemas.WEATHER_KIND, streaming=True)
    runs = tables.SeenIds(spark, f"{predictions.rstrip('/')}-runs")
    tick = ScoringTick(store, predictions.rstrip("/"), runs, tz, keep_days)
    drain(tick.start(envelopes, checkpoint, every))
    return tick.counts


def listing(
    spark: SparkSession, predictions: str, as_of: datetime | None = None, term: str = "", compat: bool = False
) -> DataFrame:
    """Recent predictions as shown to readers, optionally only those with ``term``."""
    recent = serve.recent_predictions(tables.read_predictions(spark, predictions), as_of)
    return serve.search_any(serve.display_predictions(recent, compat=compat), term)


def read_counts(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Run counts of all streams and batches, stored as parquet or delimited text."""
    if kind == "csv":
        stored = tables.read_csv(spark, path, schemas.RUN_COUNT)
    else:
        stored = spark.read.schema(schemas.RUN_COUNT).format(kind).load(path)
    return stored.select(*schemas.RUN_COUNT.names)


def register_tables(spark: SparkSession, out: str, predictions: str | None = None) -> None:
    """Make the stored tables available to SQL text as views."""
    spark.read.parquet(f"{out}/event_weather").createOrReplaceTempView("event_weather")
    read_counts(spark, f"{out}/run_count").createOrReplaceTempView("run_count")
    if predictions is not None:
        tables.read_predictions(spark, predictions).createOrReplaceTempView("predictions")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallycast")
    kinds = parser.add_subparsers(dest="job", required=True)
    options = {
        "process": ("landing", "out", "seen", "checkpoint"),
        "train": ("counts", "models"),
        "predict": ("landing", "models", "predictions", "checkpoint"),
        "list": ("predictions",),
    }
    for job, names in options.items():
        command = kinds.add_parser(job)
        for name in names:
            command.add_argument(f"--{name}", required=True)
        if job != "list":
            command.add_argument("--tz", default="UTC", help="of zoneless times and calendar parts")
        command.add_argument("--format", default="parquet", help="of the result tables: parquet or csv")
    for job in ("process", "predict"):
        kinds.choices[job].add_argument("--every", help="interval such as '1 hour'; default: what is there, then stop")
    kinds.choices["list"].add_argument("--as-of", type=datetime.fromisoformat, help="default: now")
    kinds.choices["list"].add_argument("--search", default="")
    given = parser.parse_args(argv)
    spark = build_session(f"tallycast-{given.job}")

    if given.job == "process":
        process(spark, given.landing, given.out, given.seen, given.checkpoint, given.tz, given.every, result_format=given.format)
    elif given.job == "train":
        train(spark, read_counts(spark, given.counts, given.format), given.models, given.tz)
    elif given.job == "predict":
        folders = (given.landing, given.models, given.predictions, given.checkpoint)
        print(predict(spark, *folders, given.tz, given.every))
    else:
        listing(spark, given.predictions, given.as_of, given.search).show(truncate=False)


if __name__ == "__main__":
    main()
