"""Named queries: ``(spark, sf_dir) -> DataFrame``, each over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast import schemas
from tallycast.functions import text
from tallycast.functions.wording import CITY_LABELS, label_of
from tallycast.ml import expression, features
from tallycast.ml.registry import ModelStore
from tallycast.ml.scoring import score
from tallycast.ml.training import train_forest
from tallycast.operators import align, clean, dedup, lookup, ranking, rollup, serve, summarize
from tallycast.plans import views
from tallycast.session import cut_lineage, work_path
from tallycast.sources import landing, pages, payloads, tables
from tallycast.streaming import microbatch, runs, stateful

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Reference time of the listing queries, inside the range of the events table.
AS_OF = datetime(2024, 1, 21, 12, tzinfo=timezone.utc)
#: Events collected before this time are "already seen" in drop_seen.
SEEN_UNTIL = datetime(2024, 1, 16, tzinfo=timezone.utc)


def query(run: Query) -> Query:
    """Register ``run`` under its name; it runs in UTC."""

    @functools.wraps(run)
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(run(spark, sf_dir))

    QUERIES[run.__name__] = in_utc
    return in_utc


def plain(df: DataFrame) -> DataFrame:
    """Times as epoch microseconds, fractions rounded, for comparison across engines."""
    shown = []
    for field in df.schema.fields:
        column = df[field.name]
        if isinstance(field.dataType, T.TimestampType):
            shown.append(F.unix_micros(column).alias(field.name))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            shown.append(F.round(column.cast("double"), 6).alias(field.name))
        else:
            shown.append(column)
    return df.select(*shown)


# ---------------------------------------------------------------- cleaning


@query
def clean_weather_text(spark, sf_dir):
    raw = views.weather_text(views.events(spark, sf_dir))
    return clean.type_weather(raw).select(*schemas.CLEAN_WEATHER.names)


@query
def flatten_event(spark, sf_dir):
    return clean.flatten_events(views.raw_events(views.events(spark, sf_dir)))


@query
def typed_event_explode(spark, sf_dir):
    """Each event travels with one of another type in the same JSON array."""
    source = views.events(spark, sf_dir)
    ident = F.col("event_id").cast("string")
    own = F.struct(ident.alias("id"), F.col("event_type").alias("type"))
    other = F.struct(F.concat(ident, F.lit("-crash")).alias("id"), F.lit("crash").alias("type"))
    bodies = source.select(
        F.when(F.col("user_id") % 2 == 0, "msc").otherwise("spb").alias("city_name"),
        F.floor(F.unix_seconds("ts") / 3600).cast("string").alias("scheduler_id"),
        F.to_json(F.array(own, F.when(F.col("event_id") % 3 == 0, other).otherwise(own))).alias("body"),
    )
    crashes = payloads.explode_typed_events(bodies)
    errors = payloads.explode_typed_events(bodies, event_type="error")
    return crashes.unionByName(errors).select("id", "type", "city_name", "scheduler_id")


@query
def calendar_parts(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
    )
    events = views.events(spark, sf_dir).select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("ts").alias("date")
    )
    parts = rollup.add_calendar(orders.unionByName(events), parts=["hour", "month", "weekday", "year", "day_of_year"])
    named = parts.withColumnsRenamed({"hour": "utc_hour", "weekday": "utc_weekday"})
    tokyo = rollup.add_calendar(named, tz="Asia/Tokyo", parts=["hour"]).withColumnRenamed("hour", "tokyo_hour")
    return tokyo.select("source", "id", "utc_hour", "tokyo_hour", "month", "utc_weekday", "year", "day_of_year")


# ---------------------------------------------------------------- de-duplication


@query
def dedup_events(spark, sf_dir):
    repeated = views.traffic_repeated(views.events(spark, sf_dir))
    return dedup.keep_first(repeated, ["id"], ["collected_at"])


@query
def dedup_first_order(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return dedup.keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def drop_seen(spark, sf_dir):
    repeated = views.traffic_repeated(views.events(spark, sf_dir))
    seen = repeated.filter(F.col("collected_at") < F.lit(SEEN_UNTIL)).select("id")
    batch = repeated.filter(F.col("collected_at") >= F.lit(SEEN_UNTIL))
    return dedup.first_sightings(batch, seen, ["id"], ["collected_at"])


# ---------------------------------------------------------------- alignment and counting


def _run_count(spark, sf_dir) -> DataFrame:
    source = views.events(spark, sf_dir)
    weather = views.weather(source)
    first = dedup.keep_first(weather, align.RUN_KEYS, ["date", "event_id"]).drop("event_id")
    # The earliest reading survives keep_first, so the undeduplicated minimum is the same.
    return align.count_per_run(first, views.traffic(source), first_reading=align.earliest(weather))



@query
def run_count(spark, sf_dir):
    return _run_count(spark, sf_dir)


@query
def late_filter(spark, sf_dir):
    source = views.events(spark, sf_dir)
    return align.drop_late(views.traffic(source), align.earliest(views.weather(source)))


@query
def bucket_means(spark, sf_dir):
    return align.bucket_weather(views.weather(views.events(spark, sf_dir)))


@query
def bucket_join(spark, sf_dir):
    source = views.events(spark, sf_dir)
    return align.bucket_join(views.traffic(source), views.weather(source))


@query
def lookup_records(spark, sf_dir):
    """Orders notify of customers; every tenth order twice, some customers unknown."""
    orders = views.table(spark, sf_dir, "orders")
    messages = orders.select(
        F.col("o_orderkey").cast("string").alias("schedule_id"),
        F.concat(F.lit("customer:"), (F.col("o_custkey") + 10).cast("string")).alias("cache_id"),
        F.col("o_orderstatus").alias("crawler_type"),
    )
    messages = messages.unionByName(messages.filter(F.col("schedule_id").cast("bigint") % 10 == 0))
    records = views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("key"), "c_name", "c_mktsegment"
    )
    return lookup.look_up(messages, records).drop(lookup.MATCHED)


# ---------------------------------------------------------------- aggregation


@query
def mode_per_group(spark, sf_dir):
    return summarize.most_frequent(views.table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag")


@query
def zero_fill_count(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return summarize.zero_filled_count(customers, orders, ["c_custkey"], "n_orders")


@query
def calendar_rollup(spark, sf_dir):
    return rollup.calendar_rollup(_run_count(spark, sf_dir))


@query
def calendar_rollup_all_years(spark, sf_dir):
    """Days of different years merged, on a table that spans several years."""
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("city_name"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.lit(1).alias("crashes"),
        F.floor("o_totalprice").alias("o_totalprice"),  # whole numbers sum exactly in any order
        "o_orderstatus",
    )
    return rollup.calendar_rollup(orders, means=["o_totalprice"], modes=["o_orderstatus"], by_year=False, keep_day=True)


@query
def rmse(spark, sf_dir):
    scaled = (F.col("l_extendedprice") / 1000).alias("scaled_price")
    lineitem = views.table(spark, sf_dir, "lineitem").select("l_quantity", scaled)
    return summarize.root_mean_square_error(lineitem, "l_quantity", "scaled_price")


@query
def category_index(spark, sf_dir):
    return ranking.category_index(views.table(spark, sf_dir, "part"), "p_type")


# ---------------------------------------------------------------- predictions


@query
def prediction_rows(spark, sf_dir):
    """The value column stands in for the score of a reading."""
    source = views.events(spark, sf_dir)
    scored = source.select(
        F.when(F.col("user_id") % 2 == 0, "msc").otherwise("spb").alias("city_name"),
        (F.floor(F.col("value") * 2) / 2).alias("prediction"),
        F.col("ts").alias("date"),
    )
    return serve.prediction_rows(scored)


@query
def recent_predictions(spark, sf_dir):
    return serve.recent_predictions(views.predictions(views.events(spark, sf_dir)), AS_OF)


@query
def display_predictions(spark, sf_dir):
    stored = views.predictions(views.events(spark, sf_dir))
    return serve.display_predictions(stored, {"msc": CITY_LABELS["msc"]})


@query
def display_predictions_compat(spark, sf_dir):
    return serve.display_predictions(views.predictions(views.events(spark, sf_dir)), compat=True)


@query
def search_predictions(spark, sf_dir):
    shown = serve.display_predictions(views.predictions(views.events(spark, sf_dir)))
    return serve.search_any(shown, "  ПЕТЕРбург ")


# ---------------------------------------------------------------- sources and sinks


@query
def page_fields(spark, sf_dir):
    stored = views.table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.extract_page_fields(
        stored, {"title": ("title", ""), "heading": ("h1", ""), "wind_speed": ("div.wind-speed", "calm")}
    )


@query
def page_parts(spark, sf_dir):
    """Selectors by class, id, descendants and children; every second footer has the id."""
    stored = views.table(spark, sf_dir, "pages").select("page_id", "html")
    named = F.when(F.col("page_id") % 2 == 0, F.replace("html", F.lit("<footer>"), F.lit('<footer id="end">')))
    return pages.extract_page_fields(
        stored.withColumn("html", F.coalesce(named, "html")),
        {
            "notice": ("body > div.ad", ""),
            "first_link": ("nav li > a", ""),
            "heading": ("body article > h1", ""),
            "not_a_child": ("nav > a", "none"),
            "ending": ("#end", "unnamed"),
        },
    )


@query
def route_by_kind(spark, sf_dir):
    """Event types become record kinds; one of the five is of no known kind."""
    kinds = {
        "error": schemas.TRAFFIC_KIND,
        "purchase": schemas.TRAFFIC_KIND,
        "click": schemas.WEATHER_KIND,
        "view": schemas.WEATHER_KIND,
    }
    source = views.events(spark, sf_dir)
    others = [f for f in schemas.ANY_PAYLOAD.fields if f.name != "city_name"]
    reading = [F.lit(None).cast(f.dataType).alias(f.name) for f in others]
    city = F.when(F.col("user_id") % 2 == 0, "msc").otherwise("spb").alias("city_name")
    envelopes = source.select(
        F.col("event_id").cast("string").alias("scheduler_id"),
        label_of(F.col("event_type"), kinds).alias("crawler_type"),
        F.struct(city, *reading).alias("data"),
    )
    branches = [landing.only_kind(envelopes, kind) for kind in (schemas.TRAFFIC_KIND, schemas.WEATHER_KIND)]
    chosen = [b.select("crawler_type", "scheduler_id", "data.city_name") for b in branches]
    return chosen[0].unionByName(chosen[1])


@query
def landing_roundtrip(spark, sf_dir):
    """Readings landed as JSON, read back, the newest of each (run, city) kept."""
    path = work_path(spark, "landing")
    landing.write_landing(views.weather_envelopes(views.events(spark, sf_dir)), path)
    envelopes = landing.read_landing(spark, path, schemas.WEATHER_KIND)
    newest = landing.latest_per_key(envelopes, [F.desc("data.datetime")])
    return newest.select("key", "data.*")


@query
def csv_append_roundtrip(spark, sf_dir):
    path = work_path(spark, "run-count")
    counted = cut_lineage(schemas.conform(_run_count(spark, sf_dir), schemas.RUN_COUNT))
    for city in ("msc", "spb"):
        tables.append_csv(counted.filter(F.col("city_name") == city), path)
    return tables.read_csv(spark, path, schemas.RUN_COUNT)


@query
def csv_as_text(spark, sf_dir):
    """A delimited table read without types, and typed from its data."""
    path = work_path(spark, "orders")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.append_csv(orders, path)
    plain_, typed = tables.read_csv(spark, path), tables.read_csv(spark, path, infer=True)
    kinds = F.lit(",".join(kind for _, kind in [*plain_.dtypes, *typed.dtypes])).alias("kinds")
    return plain_.join(typed.select(F.col("o_orderkey").cast("string"), (F.col("o_custkey") + 1).alias("next")), "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("next").cast("bigint").alias("next"), kinds
    )


@query
def event_times(spark, sf_dir):
    """Times as text in the forms a feed may send, with the zone of those that name none."""
    source = views.events(spark, sf_dir)
    local = F.col("ts") + F.expr("INTERVAL 3 HOURS")
    forms = (
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.date_format(local, "yyyy-MM-dd HH:mm"),
        F.date_format(local, "yyyy-MM-dd"),
        F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03")),
        F.unix_seconds("ts").cast("string"),
    )
    raw = F.get(F.array(*forms), (F.col("event_id") % len(forms)).cast("int"))
    return source.select("event_id", text.epoch_or_iso_time(raw, "Europe/Moscow").alias("date"))


@query
def prediction_sink_roundtrip(spark, sf_dir):
    path = work_path(spark, "predictions")
    rows = cut_lineage(views.predictions(views.events(spark, sf_dir)))
    for city in ("msc", "spb"):
        tables.append_predictions(rows.filter(F.col("city") == city), path)
    return serve.recent_predictions(tables.read_predictions(spark, path), AS_OF).drop(serve.END_DAY)


# ---------------------------------------------------------------- training and scoring

def _training_rows(spark, sf_dir) -> DataFrame:
    return cut_lineage(rollup.calendar_rollup(_run_count(spark, sf_dir), keep_day=True))


@query
def feature_vectors(spark, sf_dir):
    """The assembled vectors, one column per element, with their label."""
    rows = cut_lineage(rollup.calendar_rollup(_run_count(spark, sf_dir)))
    fitted = features.feature_pipeline().fit(rows)  # no number is missing here: one would fail
    elements = vector_to_array("features")
    return features.labelled(fitted, rows).select(
        "label", *[F.get(elements, i).alias(name) for i, name in enumerate(features.FEATURE_ORDER)]
    )


@query
def unscorable_rows(spark, sf_dir):
    """Encoders that know one city only, asked about both."""
    rows = cut_lineage(rollup.calendar_rollup(_run_count(spark, sf_dir)))
    fitted = features.feature_pipeline("skip", "skip").fit(rows.filter(F.col("city_name") == "msc"))
    return features.unscorable(fitted, rows)


@query
def forest_tuned_score(spark, sf_dir):
    """The whole grid; the stored model's scores beside those of its SQL text."""
    hourly = _training_rows(spark, sf_dir)
    store = ModelStore(spark, work_path(spark, "models"))
    trained = train_forest(hourly)
    store.promote_if_better(trained.model, trained.held_out)
    model = store.load()
    low, high = hourly.agg(F.min("crashes"), F.max("crashes")).first()
    dated = rollup.add_calendar(views.weather(views.events(spark, sf_dir)), "date")
    scored = expression.predict_by_sql(model, model.transform(dated).withColumnRenamed("prediction", "stored"))
    return scored.select(
        F.col("city_name").alias("city"),
        F.col("date").alias("startDate"),
        (F.col("date") + F.expr("INTERVAL 1 HOUR")).alias("endDate"),
        F.col("prediction").between(low, high).alias("in_range"),
        (F.col("stored") == F.col("prediction")).alias("agrees"),
    )


@query
def forest_grid(spark, sf_dir):
    """Every candidate's RMSE worked out anew, from its SQL text over the validation rows."""
    trained = train_forest(_training_rows(spark, sf_dir))
    encoders, rows = trained.model.stages[:-1], cut_lineage(trained.validation)
    for place, (_, _, forest) in enumerate(trained.candidates):
        candidate = PipelineModel([*encoders, forest])
        rows = expression.predict_by_sql(candidate, rows, f"p{place}")
    errors = [F.sqrt(F.avg(F.pow(F.col("crashes") - F.col(f"p{n}"), 2))).alias(f"p{n}") for n in range(len(trained.metrics))]
    found = rows.agg(*errors).first()
    best = min(range(len(found)), key=lambda n: found[n])
    table = [
        (trees, depth, abs(found[n] - trained.metrics[n]) < 1e-9, (n == best) == (trained.metrics[n] == min(trained.metrics)))
        for n, (trees, depth, _) in enumerate(trained.candidates)
    ]
    return spark.createDataFrame(table, "trees INT, depth INT, rmse_follows BOOLEAN, choice_follows BOOLEAN")


@query
def forest_promotion(spark, sf_dir):
    """A trained forest, a worse one-tree stump (not kept), the forest again (a tie)."""
    store = ModelStore(spark, work_path(spark, "models"))
    hourly = _training_rows(spark, sf_dir)
    trained = train_forest(hourly, tree_counts=(5,), depths=(8,))
    for model in (_formula("crashes + 100"), trained.model, _formula("crashes + 200"), trained.model):
        store.promote_if_better(model, trained.held_out)
    errors = expression.predict_by_sql(store.load(), trained.held_out, "p")
    rmse_ = errors.agg(F.sqrt(F.avg(F.pow(F.col("crashes") - F.col("p"), 2)))).first()[0]
    follows = F.when(F.col("decision") == 1, F.abs(F.col("new_rmse") - rmse_) < 1e-9)
    return store.ledger().select("version", "decision", F.round("old_rmse", 3).alias("old_rmse_rounded"), follows.alias("rmse_follows")).filter("decision <> -1")


def _formula(prediction: str) -> PipelineModel:
    """A stored model whose predictions follow from an SQL expression."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({prediction} AS DOUBLE) AS prediction FROM __THIS__")])


@query
def promotion_decision(spark, sf_dir):
    """First model, the same model again (a tie), a better one, then a worse one."""
    store = ModelStore(spark, work_path(spark, "models"))
    held_out = _training_rows(spark, sf_dir).filter(F.col("day_of_year") % 5 == 0)
    for prediction in ("crashes + 2", "crashes + 2", "crashes * 1.25", "crashes + 3"):
        store.promote_if_better(_formula(prediction), held_out)
    return store.ledger().drop("path")


# ---------------------------------------------------------------- streaming


def _state_size(spark) -> int:
    return spark.sparkContext.defaultParallelism


def _seen(spark, purpose: str) -> tables.SeenIds:
    return tables.SeenIds(spark, work_path(spark, purpose))


def _land_repeated(spark, sf_dir) -> DataFrame:
    """The repeated events as a stream of several triggers, what was collected first first."""
    path = work_path(spark, "repeated")
    repeated = views.traffic_repeated(views.events(spark, sf_dir))
    files = max(2, repeated.rdd.getNumPartitions())  # follows the size of the table
    early = F.col("collected_at") < F.lit(SEEN_UNTIL)
    for part in (repeated.filter(early), repeated.filter(~early)):
        part.repartition(files, "id").write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    return stream.option("maxFilesPerTrigger", files).parquet(path)


@query
def stream_dedup(spark, sf_dir):
    """Keyed state, unbounded; whichever copy arrives first stays."""
    out, checkpoint = work_path(spark, "dedup"), work_path(spark, "checkpoint")
    with runs.state_partitions(spark, _state_size(spark)):
        fresh = stateful.stateful_dedup(_land_repeated(spark, sf_dir), ["id"])
        runs.drain(runs.begin(runs.append_files(fresh, out), checkpoint))
    return spark.read.parquet(out).drop("scheduler_id", "collected_at")


def _remembered(spark, sf_dir, days: int | None = None) -> DataFrame:
    out, checkpoint = work_path(spark, "dedup"), work_path(spark, "checkpoint")
    stream = _land_repeated(spark, sf_dir)
    seen = _seen(spark, "seen")
    runs.drain(microbatch.remember_first_sightings(stream, seen, out, ["collected_at"], checkpoint, days=days))
    return spark.read.parquet(out).drop("stream", "batch", "day")


@query
def stream_dedup_limited(spark, sf_dir):
    """Ids are forgotten 60 days after the newest, longer than the table spans."""
    return _remembered(spark, sf_dir, days=60)


@query
def stream_dedup_forgetting(spark, sf_dir):
    """Every 25th event comes again days later, when some of the ids are forgotten."""
    path, out, checkpoint = (work_path(spark, p) for p in ("repeated", "dedup", "checkpoint"))
    source = views.traffic_repeated(views.events(spark, sf_dir))
    early = source.filter(F.col("collected_at") < F.lit(SEEN_UNTIL))
    number = F.col("id").cast("bigint")
    again = early.filter((number % 25 == 0) & (F.col("collected_at") == F.col("date")))
    again = again.withColumn("collected_at", F.lit(SEEN_UNTIL) + F.expr("INTERVAL 10 DAYS"))
    files = max(2, source.rdd.getNumPartitions())
    for part in (early, source.filter(F.col("collected_at") >= F.lit(SEEN_UNTIL)).unionByName(again)):
        part.repartition(files, "id").write.mode("append").parquet(path)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", files).parquet(path)
    seen = _seen(spark, "seen")
    runs.drain(microbatch.remember_first_sightings(stream, seen, out, ["collected_at"], checkpoint, days=1))
    return spark.read.parquet(out).drop("stream", "batch", "day")


@query
def stream_dedup_table(spark, sf_dir):
    """The earliest copy of each id over all batches, against the table of seen ids."""
    return _remembered(spark, sf_dir)


def _bucket_tables(spark, sf_dir, joins: bool) -> microbatch.BucketTables:
    kept = microbatch.BucketTables(work_path(spark, "buckets"), joins)
    split = lambda batch: (views.traffic(batch), views.weather(batch))
    runs.drain(kept.start(views.events_stream(spark, sf_dir), split, work_path(spark, "checkpoint")))
    return kept


@query
def stream_bucket_agg(spark, sf_dir):
    """All windows, late rows included."""
    stored = _bucket_tables(spark, sf_dir, joins=False).buckets(spark)
    start = F.timestamp_seconds(F.col("time_interval") * align.BUCKET_SECONDS).alias("window_start")
    return stored.select(start, "city_name", *align.WEATHER_MEANS, *align.WEATHER_MODES)


@query
def stream_bucket_join(spark, sf_dir):
    """All events with the weather of their window, late rows included."""
    return _bucket_tables(spark, sf_dir, joins=True).joined(spark)


@query
def stream_bucket_agg_closed(spark, sf_dir):
    """The watermarked form: windows that have closed; the newest stay open."""
    out, checkpoint = work_path(spark, "buckets"), work_path(spark, "checkpoint")
    readings = views.weather(views.events_stream(spark, sf_dir))
    with runs.state_partitions(spark, _state_size(spark)):
        closed = stateful.bucket_weather_stream(readings)
        runs.drain(runs.begin(runs.append_files(closed, out), checkpoint))
    stored = spark.read.parquet(out)
    start = F.col("window.start").alias("window_start")
    return stored.select(start, "city_name", *align.WEATHER_MEANS, *align.WEATHER_MODES)


@query
def stream_bucket_join_closed(spark, sf_dir):
    out, checkpoint = work_path(spark, "joined"), work_path(spark, "checkpoint")
    source = views.events_stream(spark, sf_dir)
    with runs.state_partitions(spark, _state_size(spark)):
        joined = stateful.bucket_join_stream(views.traffic(source), views.weather(source))
        runs.drain(runs.begin(runs.append_files(joined, out), checkpoint))
    return spark.read.parquet(out)


def _ticked(spark, sf_dir) -> microbatch.Tick:
    """Both kinds landed as JSON and processed in one tick."""
    path, out, checkpoint = (work_path(spark, p) for p in ("landing", "tick", "checkpoint"))
    source = views.events(spark, sf_dir)
    landing.write_landing(views.weather_envelopes(source, malformed=False), path)
    landing.write_landing(views.traffic_envelopes(source), path)
    tick = microbatch.Tick(out, _seen(spark, "seen"), replace_recollected=False)
    runs.drain(tick.start(landing.read_landing(spark, path, streaming=True), checkpoint))
    return tick


@query
def stream_micro_batch(spark, sf_dir):
    """The counts of one tick, read back."""
    return spark.read.parquet(_ticked(spark, sf_dir).run_count).drop("stream", "batch")


@query
def stream_event_weather(spark, sf_dir):
    """The joined events of one tick, read back; a reading of a run counts once."""
    return spark.read.parquet(_ticked(spark, sf_dir).event_weather).drop("stream", "batch")


@query
def stream_score(spark, sf_dir):
    """Landed text readings scored with the stored model as they arrive."""
    store = ModelStore(spark, work_path(spark, "models"))
    held_out = _training_rows(spark, sf_dir)
    store.promote_if_better(_formula("hour + month"), held_out)
    raw = views.weather_text(views.events_stream(spark, sf_dir), malformed=False)
    out, checkpoint = work_path(spark, "predictions"), work_path(spark, "checkpoint")
    runs.drain(stateful.start_scoring(store, raw, out, checkpoint))
    return tables.read_predictions(spark, out).drop(serve.END_DAY)
