"""The processing tick: landed envelopes -> event and count tables, batch by batch."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallycast import schemas
from tallycast.functions.timeparts import time_bucket, utc_day
from tallycast.operators.align import BUCKET_SECONDS, WEATHER_MEANS, WEATHER_MODES, bucket_join, count_per_run
from tallycast.operators.clean import clean_weather, flatten_events
from tallycast.operators.dedup import drop_seen, keep_first
from tallycast.operators.summarize import finish_summary, merge_summaries, partial_summary
from tallycast.session import read_json_if_present, remove
from tallycast.sources import landing
from tallycast.sources.tables import IN_LIST as _IN_LIST
from tallycast.sources.tables import SeenIds, append_csv
from tallycast.streaming.runs import begin, per_batch, stream_id

#: Name of a stream whose batches are handed over by the caller.
DIRECT = "direct"


@dataclass
class Tick:
    """One processing job over a landing stream.

    Both result tables and the seen ids are keyed by stream and batch number and replaced
    as a whole, so a batch that is run again after a failure leaves the same result, and a
    renewed checkpoint, which makes a new stream, touches nothing of the old one.
    Events count in the run that saw them first. An event whose reading comes in a
    later batch is not joined afterwards; the lateness bound is the earliest reading
    of the batch. Lines that are no envelope are kept aside in ``unreadable``.
    """

    out: str
    seen: SeenIds
    tz: str = "UTC"
    #: False when a run may land one city and kind in several envelopes.
    replace_recollected: bool = True
    #: ``"csv"`` writes the two result tables as delimited text with a header.
    result_format: str = "parquet"
    #: True keeps the parsed and cleaned copies of a batch after its results are written.
    keep_copies: bool = False
    #: Batches after which the parts of the seen ids are put together; 0: never.
    compact_every: int = 24

    @property
    def event_weather(self) -> str:
        return f"{self.out}/event_weather"

    @property
    def run_count(self) -> str:
        return f"{self.out}/run_count"

    @property
    def unreadable(self) -> str:
        return f"{self.out}/unreadable"

    def start(self, envelopes: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Start on a streaming ``envelopes`` frame."""
        stream = stream_id(envelopes.sparkSession, checkpoint)
        return begin(per_batch(envelopes, lambda batch, n: self.process(batch, n, stream)), checkpoint, every)

    def process(self, batch: DataFrame, batch_id: int, stream: str = DIRECT) -> None:
        """Write the results of one batch.

        The JSON is parsed once, into a copy split by kind, and the cleaned inputs
        are stored too. Later steps read the columns they need from those copies, so
        a lost executor costs a read and not the work of the whole batch.
        """
        part = f"stream={stream}/batch={batch_id}"
        copies = [f"{self.out}/{name}/{part}" for name in ("landed", "first", "events", "weather")]
        landed = store_batch(batch, copies[0], "crawler_type")
        landing.unreadable(landed).write.mode("overwrite").parquet(f"{self.unreadable}/{part}")
        sightings, readings = (self._current(landed, kind) for kind in (schemas.TRAFFIC_KIND, schemas.WEATHER_KIND))

        order = [landing.LANDED_AT, landing.LANDED_FILE]
        first = flatten_events(keep_first(landing.traffic_records(sightings), ["id"], order), self.tz)
        first = store_batch(first.withColumn("day", utc_day("date")), copies[1])
        fresh = drop_seen(first, self.seen.known(first, stream, batch_id), ["id"])
        events = store_batch(fresh, copies[2])
        weather = store_batch(clean_weather(landing.weather_records(readings), self.tz), copies[3])

        self._publish(bucket_join(events.drop("day"), weather), f"{self.event_weather}/{part}")
        self._publish(count_per_run(weather, events), f"{self.run_count}/{part}")
        self.seen.remember(events.select("id", "day"), stream, batch_id)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.seen.compact(stream, batch_id)  # this batch alone may run again
        if not self.keep_copies:
            for copy in copies:
                remove(batch.sparkSession, copy)

    def _publish(self, df: DataFrame, place: str) -> None:
        if self.result_format == "csv":
            append_csv(df, place, mode="overwrite")
        else:
            df.write.mode("overwrite").format(self.result_format).save(place)

    def _current(self, landed: DataFrame, kind: str) -> DataFrame:
        envelopes = landing.only_kind(landed, kind)
        return landing.latest_per_key(envelopes) if self.replace_recollected else envelopes


def remember_first_sightings(
    stream: DataFrame,
    seen: SeenIds,
    out: str,
    order: list,
    checkpoint: str,
    ts: str = "date",
    days: int | None = None,
) -> StreamingQuery:
    """Cross-batch de-duplication on ``id`` against the table of seen ids.

    Copies are reduced inside the tasks that read them, so an id with a large share
    of the rows does not end up in one task. No first sighting is lost, however late it
    comes. With ``days``, ids of days further than that before the middle one of a batch's
    new ids are forgotten after it; later copies of theirs count as new. A few wrong dates,
    however far ahead, do not move the middle.
    """
    name = stream_id(stream.sparkSession, checkpoint)

    def work(batch: DataFrame, batch_id: int) -> None:
        part = f"stream={name}/batch={batch_id}"
        first = keep_first(batch, ["id"], order).withColumn("day", utc_day(ts))
        first = store_batch(first, f"{out}-first/{part}")
        fresh = store_batch(drop_seen(first, seen.known(first, name, batch_id), ["id"]), f"{out}/{part}")
        seen.remember(fresh.select("id", "day"), name, batch_id)
        remove(batch.sparkSession, f"{out}-first/{part}")
        if days is not None:
            forget_old(seen, fresh, days)

    return begin(per_batch(stream, work), checkpoint)


def forget_old(seen: SeenIds, fresh: DataFrame, days: int) -> None:
    """Forget ids of more than ``days`` days before the middle day of the ``fresh`` ones."""
    middle = fresh.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date(day))")).first()[0]
    if middle is not None:
        seen.forget(date(1970, 1, 1) + timedelta(days=int(middle) - days))


@dataclass
class BucketTables:
    """Weather per bucket, and events with it, kept right however late rows come.

    Readings are not kept: a batch adds a partial summary of its own readings, and what a
    bucket is follows from merging its summaries. Events are kept by day and in the order of
    their buckets. A batch joins its new events with the merged buckets they lie in, and of
    the old events those whose buckets its readings changed; both are added to the joined
    table with the version of the bucket, the number of batches that told of it, and only
    rows of the newest version count. So a late row costs the summaries and events of its
    bucket, not its day; nothing is dropped for coming late and no state grows with the stream.

    Every batch of every stream has a part of its own in each table, which it replaces if it
    is run again. One stream at a time writes to the tables.
    """

    out: str
    #: False keeps summaries only; events are then ignored.
    joins: bool = True

    def start(self, stream: DataFrame, split, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Start; ``split`` gives the events and the readings of a batch."""
        name = stream_id(stream.sparkSession, checkpoint)

        def work(batch: DataFrame, batch_id: int) -> None:
            self.process(*split(batch), batch_id, name)

        return begin(per_batch(stream, work), checkpoint, every)

    def process(self, events: DataFrame, readings: DataFrame, batch_id: int, stream: str = DIRECT) -> None:
        part = f"stream={stream}/batch={batch_id}"
        bucketed = readings.select(_bucket_of(), *_CITY, *WEATHER_MEANS, *WEATHER_MODES)
        told = partial_summary(bucketed, _BUCKET_KEYS, WEATHER_MEANS, WEATHER_MODES)
        told = self._add("summaries", told, part)
        if not self.joins:
            return
        new = self._add("events", events.withColumn(_BUCKET, _bucket_of()), part)
        spark = told.sparkSession
        own = (F.col("stream") == stream) & (F.col("batch") == batch_id)

        changed = told.select(*_BUCKET_KEYS).distinct()
        wanted = changed.unionByName(new.select(*_BUCKET_KEYS)).distinct()
        summaries = _of_buckets(self._read("summaries", spark), wanted)
        parts = summaries.select(*_BUCKET_KEYS, "stream", "batch").distinct()
        versions = parts.groupBy(*_BUCKET_KEYS).agg(F.count(F.lit(1)).alias(_VERSION))
        current = _finished(summaries).join(versions, list(_BUCKET_KEYS))
        key = F.struct(*_BUCKET_KEYS).alias(_KEY)  # AQE splits a hot bucket: see align.bucket_join
        current = current.select(key, *WEATHER_MEANS, *WEATHER_MODES, _VERSION)

        kept = [name for name in events.columns if name not in ("scheduler_id", *_CITY)]
        old = _of_buckets(self._read("events", spark).filter(~own), changed)
        met = [side.select(*kept, *_BUCKET_KEYS, key).join(current, _KEY).drop(_KEY) for side in (new, old)]
        self._add("joined", met[0].unionByName(met[1]), part)

    def buckets(self, spark: SparkSession) -> DataFrame:
        """``time_interval, city_name`` and the weather; readings without a time have a NULL bucket."""
        return _finished(self._read("summaries", spark))

    def joined(self, spark: SparkSession) -> DataFrame:
        """Every event with the weather of its bucket; events without any are left out."""
        rows = self._read("joined", spark)
        newest = rows.groupBy(*_BUCKET_KEYS).agg(F.max(_VERSION).alias(_VERSION))
        key = F.struct(*_BUCKET_KEYS, _VERSION).alias(_KEY)
        found = rows.withColumn(_KEY, key).join(newest.select(key), _KEY, "left_semi")
        return found.drop(_KEY, _VERSION, _BUCKET, "day", "stream", "batch")

    def _add(self, name: str, rows: DataFrame, part: str) -> DataFrame:
        """Write a part of table ``name``, by day and in bucket order, and return the written copy."""
        day = utc_day(F.timestamp_seconds(F.col(_BUCKET) * BUCKET_SECONDS))
        placed = rows.withColumn("day", day).hint("rebalance", "day").sortWithinPartitions("day", *_BUCKET_KEYS)
        place, spark = f"{self.out}/{name}", rows.sparkSession
        if self._schema(name, spark) is None:
            stored = spark.createDataFrame([(placed.schema.json(),)], "schema STRING")
            stored.coalesce(1).write.mode("append").json(f"{place}-schema")
        placed.write.mode("overwrite").partitionBy("day").parquet(f"{place}/{part}")
        return spark.read.schema(placed.schema).parquet(f"{place}/{part}")

    def _schema(self, name: str, spark: SparkSession) -> T.StructType | None:
        """Columns of table ``name`` as its first part had them."""
        stored = read_json_if_present(spark, f"{self.out}/{name}-schema", "schema STRING")
        return None if stored is None else T.StructType.fromJson(json.loads(stored.first()["schema"]))

    def _read(self, name: str, spark: SparkSession) -> DataFrame:
        """All parts of table ``name``, with their ``stream`` and ``batch``."""
        schema = self._schema(name, spark)
        if schema is None:
            raise FileNotFoundError(f"no {name} in {self.out}")
        return spark.read.schema(T.StructType([*schema.fields, *_PART])).parquet(f"{self.out}/{name}")


_CITY = ("city_name",)
_BUCKET, _KEY, _VERSION = "time_interval", "__key", "__version"
_BUCKET_KEYS = (_BUCKET, *_CITY)
_PART = (T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType()))
#: Intervals that are named to the scan one by one; of more it is told the range.
_NAMED = 200


def _bucket_of() -> Column:
    return time_bucket("date", BUCKET_SECONDS).alias(_BUCKET)


def _finished(summaries: DataFrame) -> DataFrame:
    """Stored summaries -> one row per bucket."""
    settings = (_BUCKET_KEYS, WEATHER_MEANS, WEATHER_MODES)
    return finish_summary(merge_summaries(summaries, *settings), *settings)


def _of_buckets(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Rows of a stored table whose bucket is in ``buckets``; a missing time or city is in none.

    The scan is told the days and intervals first: files are sorted by them, so it reads the
    pieces that hold such rows.
    """
    spark = rows.sparkSession
    times = buckets.select(_BUCKET).filter(f"{_BUCKET} is not null").distinct()
    named = [r[0] for r in times.limit(_NAMED + 1).collect()]
    if len(named) > _NAMED:
        low, high = times.agg(F.min(_BUCKET), F.max(_BUCKET)).first()
        inside = F.col(_BUCKET).between(low, high)
    else:
        low, high = (min(named), max(named)) if named else (1, 0)
        if int(spark.conf.get(_IN_LIST)) < _NAMED:
            spark.conf.set(_IN_LIST, str(_NAMED))  # else Spark looks at the least and greatest alone
        inside = F.col(_BUCKET).isin(*named) if named else F.lit(False)
    days = [F.lit(date(1970, 1, 1) + timedelta(seconds=t * BUCKET_SECONDS)) for t in (low, high)]
    near = rows.filter(F.col("day").between(*days) & inside)
    return near.join(buckets, list(_BUCKET_KEYS), "left_semi")


def store_batch(df: DataFrame, place: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as the data of one batch and return the written copy."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
