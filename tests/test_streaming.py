import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.ml.registry import ModelStore
from tallycast.operators import align, clean, summarize
from tallycast.plans import jobs, views
from tallycast.sources import landing, tables
from tallycast.streaming import microbatch, runs, scoring, stateful

START = datetime(2022, 12, 25, 7, 0, tzinfo=timezone.utc)


def land(path, name, *records):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in records))


def traffic(run, *events, city="spb"):
    items = [{"id": i, "type": "crash", "timestamp": (START + timedelta(minutes=m)).timestamp()} for i, m in events]
    return {"scheduler_id": run, "crawler_type": schemas.TRAFFIC_KIND, "data": {"city_name": city, "events": items}}


def reading(run, minute, temperature, city="spb"):
    when = (START + timedelta(minutes=minute)).isoformat()
    data = {"city_name": city, "temperature": temperature, "humidity": "80%", "pressure": "745 mm", "wind_speed": "1,5",
            "weather_type": "snow", "wind_direction": "N", "datetime": when}
    return {"scheduler_id": run, "crawler_type": schemas.WEATHER_KIND, "data": data}


def counts(spark, tick):
    return {r["temperature"]: r["crashes"] for r in spark.read.parquet(tick.run_count).collect()}


def test_tick_works_off_what_is_new(spark, tmp_path):
    landed, args = tmp_path / "in", [str(tmp_path / n) for n in ("out", "seen", "checkpoint")]
    run = lambda: jobs.process(spark, str(landed), *args)

    land(landed, "0.json", traffic("r1", ("a", 1), ("b", 2)), reading("r1", 1, "−1"))
    tick = run()
    assert counts(spark, tick) == {-1: 2}
    run()  # nothing new
    assert counts(spark, tick) == {-1: 2}

    land(landed, "1.json", traffic("r2", ("b", 2), ("c", 16)), reading("r2", 16, "5"), reading("r3", 31, "7"))
    run()
    assert counts(spark, tick) == {-1: 2, 5: 1, 7: 0}
    joined = spark.read.parquet(tick.event_weather)
    assert {r["id"]: r["temperature"] for r in joined.collect()} == {"a": -1.0, "b": -1.0, "c": 5.0}


def test_a_batch_run_twice_leaves_one_result(spark, tmp_path):
    landed = tmp_path / "in"
    land(landed, "0.json", traffic("r1", ("a", 1)), reading("r1", 1, "1"))
    tick = microbatch.Tick(str(tmp_path / "out"), tables.SeenIds(spark, str(tmp_path / "seen")))
    batch = landing.read_landing(spark, str(landed))
    for _ in range(2):
        tick.process(batch, 3)
    assert counts(spark, tick) == {1: 1}
    assert tick.seen.ids().count() == 1


@pytest.mark.parametrize("broken", ["run_count", "seen ids"])
def test_a_tick_that_fails_half_way_is_run_again_from_its_checkpoint(spark, tmp_path, monkeypatch, broken):
    first = [traffic("r1", ("a", 1), ("b", 2)), reading("r1", 1, "1")]
    second = [traffic("r2", ("b", 2), ("c", 16)), reading("r2", 16, "5"), reading("r3", 31, "7")]
    publish = microbatch.Tick._publish

    def stops(self, df, place):
        if "run_count" in place:
            raise OSError("no space between the two tables")
        publish(self, df, place)

    def forgets(*_):
        raise OSError("no space for the seen ids")

    def run(name):
        return jobs.process(spark, str(tmp_path / f"{name}-in"), *[str(tmp_path / f"{name}-{n}") for n in ("out", "seen", "cp")])

    def start(name):
        land(tmp_path / f"{name}-in", "0.json", *first)
        with (tmp_path / f"{name}-in" / "0.json").open("a") as file:
            file.write('\n{"scheduler_id": "r9", "crawl')
        land(tmp_path / f"{name}-in", "collected-again.json", reading("r1", 2, "3"))
        later = (tmp_path / f"{name}-in" / "0.json").stat().st_mtime + 60
        os.utime(tmp_path / f"{name}-in" / "collected-again.json", (later, later))

    start("whole")
    run("whole")
    start("again")
    with monkeypatch.context() as patch:
        target = (microbatch.Tick, "_publish", stops) if broken == "run_count" else (tables.SeenIds, "remember", forgets)
        patch.setattr(*target)
        with pytest.raises(StreamingQueryException):
            run("again")
    ticks = []
    for name in ("whole", "again"):
        land(tmp_path / f"{name}-in", "1.json", *second)
        ticks.append(run(name))

    def rows(path):
        stored = spark.read.parquet(path)
        return sorted(map(repr, stored.drop("stream", "landed_at", "landed_file").collect()))

    whole, again = ticks
    assert counts(spark, again) == {3: 2, 5: 1, 7: 0}
    assert rows(again.run_count) == rows(whole.run_count) and rows(again.event_weather) == rows(whole.event_weather)
    assert [spark.read.parquet(t.unreadable).count() for t in ticks] == [1, 1]
    assert sorted(r["id"] for r in again.seen.ids().collect()) == ["a", "b", "c"]


def test_tick_without_events_or_without_readings(spark, tmp_path):
    for name, record, expected in [("w", reading("r1", 1, "1"), {1: 0}), ("t", traffic("r1", ("a", 1)), {})]:
        land(tmp_path / name, "0.json", record)
        tick = jobs.process(spark, str(tmp_path / name), *[str(tmp_path / f"{name}-{n}") for n in ("out", "seen", "cp")])
        assert counts(spark, tick) == expected


def test_one_batch_equals_the_batch_operators(spark, sf_dir, tmp_path):
    source = views.events(spark, sf_dir)
    landed = str(tmp_path / "in")
    landing.write_landing(views.weather_envelopes(source), landed)
    landing.write_landing(views.traffic_envelopes(source), landed)
    tick = microbatch.Tick(str(tmp_path / "out"), tables.SeenIds(spark, str(tmp_path / "seen")), replace_recollected=False)
    runs.drain(tick.start(landing.read_landing(spark, landed, streaming=True), str(tmp_path / "cp")))

    envelopes = landing.read_landing(spark, landed)
    events = clean.clean_events(landing.traffic_records(envelopes))
    weather = clean.clean_weather(landing.weather_records(envelopes))
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(spark.read.parquet(tick.run_count).drop("stream", "batch")) == key(align.count_per_run(weather, events))
    assert key(spark.read.parquet(tick.event_weather).drop("stream", "batch")) == key(align.bucket_join(events, weather))


def test_results_as_delimited_text_and_as_sql_views(spark, tmp_path):
    land(tmp_path / "in", "0.json", traffic("r1", ("a", 1), ("b", 2)), reading("r1", 1, "−1"), reading("r2", 31, "4"))
    shared = [str(tmp_path / "in")]
    ticks = {
        kind: jobs.process(spark, *shared, *[str(tmp_path / f"{kind}-{n}") for n in ("out", "seen", "cp")], result_format=kind)
        for kind in ("csv", "parquet")
    }
    key = lambda kind: sorted(map(repr, jobs.read_counts(spark, ticks[kind].run_count, kind).collect()))
    assert key("csv") == key("parquet") and len(key("csv")) == 2
    jobs.register_tables(spark, ticks["parquet"].out)
    assert spark.sql("SELECT sum(crashes) FROM run_count").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM event_weather").first()[0] == 2


def test_dedup_does_not_depend_on_how_input_is_cut_into_files(spark, sf_dir, tmp_path):
    repeated = views.traffic_repeated(views.events(spark, sf_dir))
    expected = sorted(r["id"] for r in repeated.select("id").distinct().collect())
    for pieces in (1, 3):
        source = str(tmp_path / f"in{pieces}")
        repeated.repartition(pieces).write.parquet(source)
        stream = spark.readStream.schema(repeated.schema).option("maxFilesPerTrigger", 1).parquet(source)
        forms = {
            "forever": stateful.stateful_dedup(stream, ["id"]),
        }
        for name, fresh in forms.items():
            out = str(tmp_path / f"{name}{pieces}")
            with runs.state_partitions(spark, 2):
                runs.drain(runs.begin(runs.append_files(fresh, out), out + "-cp"))
            assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == expected
        out = str(tmp_path / f"table{pieces}")
        seen = tables.SeenIds(spark, out + "-seen")
        runs.drain(microbatch.remember_first_sightings(stream, seen, out, ["collected_at"], out + "-cp"))
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == expected


def test_state_partitions_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runs.state_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_train_predict_and_list(spark, sf_dir, tmp_path):
    models, stored, landed = (str(tmp_path / n) for n in ("models", "predictions", "landed"))
    source = views.events(spark, sf_dir)
    landing.write_landing(views.weather_envelopes(source, malformed=False), landed)
    predict = lambda: jobs.predict(spark, landed, models, stored, str(tmp_path / "cp"))
    assert predict() is None

    weather = clean.clean_weather(views.weather_text(source, malformed=False))
    assert jobs.train(spark, align.count_per_run(weather, views.traffic(source)), models, tree_counts=(2,), depths=(3,)) == 0
    once = weather.select("city_name", "scheduler_id").distinct().count()
    assert predict() == {"rows": once, "dropped": 0}
    assert tables.read_predictions(spark, stored).count() == once
    assert predict() == {"rows": 0, "dropped": 0}  # nothing new, nothing stored again
    assert tables.read_predictions(spark, stored).count() == once

    shown = jobs.listing(spark, stored, datetime(2024, 1, 21, 12))
    assert 0 < shown.count() < once
    assert jobs.listing(spark, stored, datetime(2024, 1, 21, 12), "москва").count() < shown.count()


def test_scoring_uses_the_zone_of_training(spark, sf_dir, tmp_path):
    hours = PipelineModel([SQLTransformer(statement="SELECT *, CAST(hour AS DOUBLE) AS prediction FROM __THIS__")])
    store = ModelStore(spark, str(tmp_path / "models"))
    held_out = spark.createDataFrame([(1, 1)], "hour int, crashes int")
    assert store.promote_if_better(hours, held_out, tz="Europe/Moscow") == 0 and store.zone() == "Europe/Moscow"
    land(tmp_path / "in", "0.json", reading("r1", 1, "1"), reading("r1", 1, "1"), reading("r2", 1, "n/a"))
    found = jobs.predict(spark, str(tmp_path / "in"), str(tmp_path / "models"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert found == {"rows": 2, "dropped": 1}
    # 07:01 UTC is hour 10 in Moscow, as the roll-up of training has it
    stored = tables.read_predictions(spark, str(tmp_path / "out"))
    assert [r["crashes"] for r in stored.filter("crashes is not null").limit(1).collect()] == [10]


def _runs_model(spark, path):
    store = ModelStore(spark, str(path))
    model = PipelineModel([SQLTransformer(statement="SELECT *, CAST(temperature AS DOUBLE) AS prediction FROM __THIS__")])
    store.promote_if_better(model, spark.createDataFrame([(1, 1)], "temperature int, crashes int"))
    return store


def test_a_recollected_run_is_scored_once_and_its_newest_copy(spark, tmp_path):
    _runs_model(spark, tmp_path / "models")
    place = lambda n: str(tmp_path / n)
    predict = lambda checkpoint="cp": jobs.predict(spark, place("in"), place("models"), place("out"), place(checkpoint))
    nameless = reading("x", 3, "7", city=None)
    land(tmp_path / "in", "0.json", reading("r1", 1, "1"), nameless, nameless)
    land(tmp_path / "in", "1.json", reading("r1", 1, "2"))
    later = (tmp_path / "in" / "0.json").stat().st_mtime + 60
    os.utime(tmp_path / "in" / "1.json", (later, later))
    assert predict() == {"rows": 3, "dropped": 0}
    land(tmp_path / "in", "2.json", reading("r1", 1, "9"), reading("r1", 1, "4", city="msc"), reading("r2", 9, "5"))
    assert predict() == {"rows": 2, "dropped": 0}
    scored = lambda: sorted(r["crashes"] for r in tables.read_predictions(spark, place("out")).filter("city is not null").collect())
    assert scored() == [2, 4, 5]
    predict("renewed")  # an other stream: the runs are remembered, readings without a name are not
    assert scored() == [2, 4, 5]


def test_remembered_runs_do_not_grow_with_the_stream(spark, tmp_path):
    store, size = _runs_model(spark, tmp_path / "models"), []
    seen = tables.SeenIds(spark, str(tmp_path / "runs"), buckets=1)
    tick = scoring.ScoringTick(store, str(tmp_path / "out"), seen, keep_days=2, compact_every=2)
    for n in range(12):
        land(tmp_path / f"in{n}", "0.json", reading(f"r{n}", 1440 * n, str(n)), reading(f"r{n - 1}", 1440 * (n - 1), "99"))
        batch = landing.read_landing(spark, str(tmp_path / f"in{n}"), schemas.WEATHER_KIND)
        tick.process(batch, n)
        if n == 5:
            tick.process(batch, n)  # run again after a failure
        size.append(sum(f.stat().st_size for f in (tmp_path / "runs" / "ids").rglob("*.parquet")))
        if n % 2:
            assert len(list((tmp_path / "runs" / "ids").rglob("*.parquet"))) <= 4
    assert seen.ids().select("id").distinct().count() <= 4 and max(size[6:]) <= max(size[:6])
    stored = sorted(r["crashes"] for r in tables.read_predictions(spark, str(tmp_path / "out")).collect())
    assert stored == [*range(12), 99]  # 99: the run before the first one


def test_a_new_checkpoint_keeps_old_ids_out_and_loses_none(spark, tmp_path):
    landed, seen = tmp_path / "in", str(tmp_path / "seen")
    out = [str(tmp_path / "out"), seen]
    land(landed, "0.json", traffic("r1", ("a", 1), ("b", 2)), reading("r1", 1, "1"))
    jobs.process(spark, str(landed), *out, str(tmp_path / "cp1"))
    other = tmp_path / "other"
    land(other, "0.json", traffic("r2", ("a", 1), ("z", 3)), reading("r2", 1, "2"))
    tick = jobs.process(spark, str(other), *out, str(tmp_path / "cp2"))
    assert sorted(r["id"] for r in tick.seen.ids().collect()) == ["a", "b", "z"]
    assert counts(spark, tick) == {1: 2, 2: 1}  # the first stream's result is still there


def test_late_first_sightings_are_kept(spark, tmp_path):
    schema = "id string, date timestamp"
    stream_in = str(tmp_path / "in")
    for day in ("2024-06-02", "2024-01-01"):
        spark.sql(f"select 'at {day}' id, timestamp'{day} 10:00:00' date").coalesce(1).write.mode("append").parquet(stream_in)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(stream_in)
    seen, out = tables.SeenIds(spark, str(tmp_path / "seen")), str(tmp_path / "out")
    runs.drain(microbatch.remember_first_sightings(stream, seen, out, ["date"], str(tmp_path / "cp"), days=60))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["at 2024-01-01", "at 2024-06-02"]


def test_unreadable_lines_are_kept_aside(spark, tmp_path):
    land(tmp_path / "in", "0.json", traffic("r1", ("a", 1)), reading("r1", 1, "1"))
    with open(tmp_path / "in" / "0.json", "a") as more:
        more.write('\n{"scheduler_id": "r9", "crawler_ty')
    tick = jobs.process(spark, str(tmp_path / "in"), *[str(tmp_path / n) for n in ("out", "seen", "cp")])
    assert counts(spark, tick) == {1: 1}
    assert [r["landed_text"] for r in spark.read.parquet(tick.unreadable).collect()] == ['{"scheduler_id": "r9", "crawler_ty']


def rounded(df):
    return sorted(map(repr, df.select(*[F.round(c, 6).alias(c) if c in align.WEATHER_MEANS else F.col(c) for c in sorted(df.columns)]).collect()))


def test_late_rows_change_their_buckets(spark, sf_dir, tmp_path):
    source = views.events(spark, sf_dir)
    events, weather = views.traffic(source), views.weather(source)
    no_time = weather.filter("event_id % 40 = 1").withColumn("date", F.lit(None).cast("timestamp"))
    weather = weather.unionByName(no_time)
    kept = microbatch.BucketTables(str(tmp_path / "out"))
    for number, part in enumerate((F.col("date") >= "2024-01-15", F.col("date") < "2024-01-15")):
        kept.process(events.filter(part), weather.filter(part).filter("event_id % 2 = 0"), number)
    late = weather.filter(F.col("date").isNull() | (F.col("event_id") % 2 == 1))
    for _ in range(2):  # run again after a failure
        kept.process(events.limit(0), late, 2)
    assert rounded(kept.joined(spark)) == rounded(align.bucket_join(events, weather))
    assert rounded(kept.buckets(spark)) == rounded(align.bucket_weather(weather))
    assert kept.buckets(spark).filter("time_interval is null").count()


def test_what_a_trigger_reads_follows_its_rows(spark, tmp_path):
    """Many buckets of one day; a late reading, and a late event, of one of them."""
    kept = microbatch.BucketTables(str(tmp_path / "out"))
    reading = "id event_id, 'spb' city_name, 'r' scheduler_id, 0.5D humidity, 740 pressure, 1.0D wind_speed, 'snow' weather_type, 'N' wind_direction"
    for hour in range(4):
        moment = f"timestamp_seconds({START.timestamp()} + {hour} * 3600 + id % 60)"
        rows = spark.range(200)
        events = rows.selectExpr(f"concat({hour}, '-', id) id", "'spb' city_name", "'r' scheduler_id", f"{moment} date")
        kept.process(events, rows.selectExpr(*reading.split(", "), f"{moment} date", "cast(id % 9 as int) temperature"), hour)
    late = spark.range(1).selectExpr(*reading.split(", "), f"timestamp_seconds({START.timestamp()} + 2 * 3600) date", "90 temperature")
    kept.process(events.limit(0), late, 4)
    part = spark.read.parquet(str(tmp_path / "out" / "joined" / "stream=direct" / "batch=4"))
    assert part.count() == 200  # events of that bucket alone are joined again
    touched = part.select("time_interval", "city_name").distinct()
    stored = microbatch._of_buckets(kept._read("events", spark), touched)
    stored.collect()
    final = stored._jdf.queryExecution().executedPlan()
    leaves = (final.finalPhysicalPlan() if "Adaptive" in final.nodeName() else final).collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).nodeName().startswith("Scan parquet")]
    read = [scan.metrics().apply("numOutputRows").value() for scan in scans]
    assert read and max(read) <= 200, [leaves.apply(i).nodeName() for i in range(leaves.size())]  # of 800 events of the day
    temperatures = {r["temperature"] for r in kept.joined(spark).filter("id like '2-%'").collect()}
    assert len(temperatures) == 1 and kept.joined(spark).count() == 800


def test_summaries_merge_to_the_whole(spark, sf_dir):
    weather = views.weather(views.events(spark, sf_dir)).withColumn("k", F.col("event_id") % 5)
    settings = (["city_name", "k"], ["humidity"], ["weather_type", "wind_direction"], ["pressure"], ["temperature"])
    parts = [summarize.partial_summary(weather.filter(F.col("event_id") % 3 == n), *settings) for n in range(3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = summarize.finish_summary(summarize.merge_summaries(whole, *settings), *settings)
    assert rounded(merged) == rounded(summarize.summarize(weather, *settings))
    plain = (["city_name"], ["humidity"], [], ["pressure"], [])
    parts = [summarize.partial_summary(weather.filter(F.col("event_id") % 3 == n), *plain) for n in range(3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rounded(summarize.finish_summary(summarize.merge_summaries(whole, *plain), *plain)) == rounded(summarize.summarize(weather, *plain))


def test_one_date_far_ahead_forgets_nothing(spark, tmp_path):
    stream_in, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2999-01-01")], [("a", "2024-01-01"), ("d", "2024-01-03")]):
        frame = spark.createDataFrame(rows, "id string, date string").withColumn("date", F.col("date").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(stream_in)
    stream = spark.readStream.schema("id string, date timestamp").option("maxFilesPerTrigger", 1).parquet(stream_in)
    seen = tables.SeenIds(spark, str(tmp_path / "seen"))
    runs.drain(microbatch.remember_first_sightings(stream, seen, out, ["date"], str(tmp_path / "cp"), days=1))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]


def test_ticks_put_the_parts_of_seen_ids_together(spark, tmp_path):
    landed = tmp_path / "in"
    tick = microbatch.Tick(str(tmp_path / "out"), tables.SeenIds(spark, str(tmp_path / "seen")), compact_every=3)
    for n in range(3):
        land(landed, "0.json", traffic(f"r{n}", ("a", 1), (f"b{n}", 2)), reading(f"r{n}", 1, str(n)))
        tick.process(landing.read_landing(spark, str(landed)), n)
    parts = {(r["level"], r["batch"]) for r in tick.seen.ids().select("level", "batch").distinct().collect()}
    assert parts == {(1, 1), (0, 2)} and counts(spark, tick) == {0: 2, 1: 1, 2: 1}


def in_time_order(spark, frame, folder, pieces=3):
    """Land ``frame`` as files whose order is the order of their times; one per trigger."""
    folder.mkdir()
    rows = frame.orderBy("date").toPandas()
    size = -(-len(rows) // pieces)
    for n in range(pieces):
        rows.iloc[n * size : (n + 1) * size].to_parquet(folder / f"{n}.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_windows_of_files_in_time_order_equal_the_batch(spark, sf_dir, tmp_path):
    source = views.events(spark, sf_dir)
    readings = views.weather(source).drop("event_id")
    out = str(tmp_path / "out")
    with runs.state_partitions(spark, 2):
        closed = stateful.bucket_weather_stream(in_time_order(spark, readings, tmp_path / "in"))
        runs.drain(runs.begin(runs.append_files(closed, out), str(tmp_path / "cp")))
    key = lambda df: sorted(map(repr, df.collect()))
    bucket = (F.unix_seconds("window.start") / 900).cast("bigint").alias("time_interval")
    columns = ["city_name", *[F.round(c, 6).alias(c) for c in align.WEATHER_MEANS], *align.WEATHER_MODES]
    batch = align.bucket_weather(readings)
    limit = readings.select(F.max("date") - F.expr("INTERVAL 300 SECONDS")).first()[0].timestamp()
    finished = batch.filter((F.col("time_interval") + 1) * 900 <= F.lit(limit))
    assert key(spark.read.parquet(out).select(bucket, *columns)) == key(finished.select("time_interval", *columns))


def test_slices_do_not_change_the_joined_rows(spark, sf_dir, tmp_path):
    source = views.events_stream(spark, sf_dir)
    found = []
    for slices in (1, 5):
        out = str(tmp_path / f"out{slices}")
        with runs.state_partitions(spark, 2):
            joined = stateful.bucket_join_stream(views.traffic(source), views.weather(source), slices=slices)
            runs.drain(runs.begin(runs.append_files(joined, out), f"{out}-cp"))
        found.append(sorted(map(repr, spark.read.parquet(out).collect())))
    assert found[0] == found[1] and found[0]
