"""The scoring tick: landed weather envelopes -> predictions, each run once."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallycast import schemas
from tallycast.functions.timeparts import utc_day
from tallycast.ml.registry import ModelStore
from tallycast.ml.scoring import score
from tallycast.operators.align import WEATHER_MEANS
from tallycast.operators.clean import type_weather
from tallycast.operators.dedup import drop_seen, keep_first
from tallycast.operators.serve import END_DAY, end_day
from tallycast.session import remove
from tallycast.sources import landing
from tallycast.sources.tables import SeenIds
from tallycast.streaming.microbatch import DIRECT, forget_old, store_batch
from tallycast.streaming.runs import begin, per_batch, stream_id


@dataclass
class ScoringTick:
    """Scores the readings of each batch with the current model.

    Of the copies of a run inside a batch the newest is scored; a run that an earlier batch
    scored is left out. What is remembered are the runs of the last ``keep_days`` days
    before the middle one of a batch, so it does not grow with the age of the stream, and a
    run that is collected again later than that is scored again. Readings without a city
    or a run id are all scored: nothing says that they repeat each other. Results and runs
    are replaced per stream and batch number, so a batch that is run again adds nothing.
    """

    model: ModelStore
    predictions: str
    seen: SeenIds
    tz: str = "UTC"
    keep_days: int = 30
    #: Batches after which the parts of the remembered runs are put together; 0: never.
    compact_every: int = 24
    #: Readings that this object scored, and those of them that lack a number.
    counts: dict[str, int] = field(default_factory=lambda: {"rows": 0, "dropped": 0})

    def start(self, envelopes: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Start on a streaming ``envelopes`` frame."""
        stream = stream_id(envelopes.sparkSession, checkpoint)
        return begin(per_batch(envelopes, lambda batch, n: self.process(batch, n, stream)), checkpoint, every)

    def process(self, batch: DataFrame, batch_id: int, stream: str = DIRECT) -> None:
        """Write the predictions of one batch and remember its runs."""
        part = f"stream={stream}/batch={batch_id}"
        copies = [f"{self.predictions}-{name}/{part}" for name in ("typed", "fresh")]
        readings = landing.only_kind(batch, schemas.WEATHER_KIND)
        readings = readings.withColumn("id", _run("data.city_name", "scheduler_id"))
        newest = [F.desc(landing.LANDED_AT), F.desc(landing.LANDED_FILE)]
        once = keep_first(readings.filter("id is not null"), ["id"], newest).unionByName(readings.filter("id is null"))
        typed = type_weather(landing.weather_records(once), self.tz)
        typed = typed.withColumn("id", _run("city_name", "scheduler_id")).withColumn("day", utc_day("date"))
        typed = store_batch(typed, copies[0])
        fresh = store_batch(drop_seen(typed, self.seen.known(typed, stream, batch_id), ["id"]), copies[1])

        predicted = score(self.model.load(), fresh.drop("id", "day"), self.model.zone())
        placed = predicted.withColumn(END_DAY, end_day(F.col("endDate")))
        writer = placed.hint("rebalance", END_DAY).write.mode("overwrite").partitionBy(END_DAY)
        writer.parquet(f"{self.predictions}/{part}")
        self.seen.remember(fresh.filter("id is not null").select("id", "day"), stream, batch_id)
        forget_old(self.seen, fresh, self.keep_days)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.seen.compact(stream, batch_id)  # this batch alone may run again

        missing = F.greatest(*[F.col(c).isNull() for c in (*WEATHER_MEANS, "date")])
        found = fresh.agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("dropped")).first().asDict()
        self.counts = {name: n + found[name] for name, n in self.counts.items()}
        for copy in copies:
            remove(batch.sparkSession, copy)


def _run(city: str, run: str) -> Column:
    """Name of a run of a city, NULL where either is."""
    named = F.col(city).isNotNull() & F.col(run).isNotNull()
    return F.when(named, F.to_json(F.array(F.col(city), F.col(run))))
