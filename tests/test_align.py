from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.operators import align, dedup, lookup, skew, summarize

START = datetime(2024, 1, 1, 10, 0, 0)


def at(seconds):
    return START + timedelta(seconds=seconds)


def weather(spark, *rows):
    """Rows of (city, run, seconds, temperature, weather type)."""
    values = [(0.5, 740, t, w, "N", 1.0, at(s), c, r) for c, r, s, t, w in rows]
    return spark.createDataFrame(values, schemas.CLEAN_WEATHER)


def events(spark, *rows):
    """Rows of (id, city, run, seconds)."""
    return spark.createDataFrame([(i, 59.0, 30.0, 0, 0, at(s), c, r) for i, c, r, s in rows], schemas.CLEAN_EVENT)


def test_count_per_run_fills_zero_and_ignores_events_without_reading(spark):
    readings = weather(spark, ("spb", "r1", 0, 1, "snow"), ("spb", "r2", 900, 2, "snow"), ("msc", "r1", 0, 3, "rain"))
    seen = events(spark, ("a", "spb", "r1", 10), ("b", "spb", "r1", 20), ("c", "msc", "r9", 30))
    counted = align.count_per_run(readings, seen)
    assert counted.columns == schemas.RUN_COUNT.names
    assert {(r["city_name"], r["temperature"]): r["crashes"] for r in counted.collect()} == {
        ("spb", 1): 2, ("spb", 2): 0, ("msc", 3): 0,
    }


def test_lateness_bound_is_strict(spark):
    readings = weather(spark, ("spb", "r1", 0, 1, "snow"))
    late = events(spark, ("at bound", "spb", "r1", -300), ("inside", "spb", "r1", -299))
    kept = align.drop_late(late, align.earliest(readings))
    assert [r["id"] for r in kept.collect()] == ["inside"]


def test_no_readings_keep_no_events(spark):
    none = schemas.empty(spark, schemas.CLEAN_WEATHER)
    some = events(spark, ("a", "spb", "r1", 0))
    assert align.drop_late(some, align.earliest(none)).count() == 0
    assert align.count_per_run(none, some).count() == 0
    assert align.bucket_join(some, none).count() == 0


def test_no_events_give_zero_counts(spark):
    readings = weather(spark, ("spb", "r1", 0, 1, "snow"))
    counted = align.count_per_run(readings, schemas.empty(spark, schemas.CLEAN_EVENT))
    assert [r["crashes"] for r in counted.collect()] == [0]


def test_bucket_join_uses_only_the_own_bucket(spark):
    readings = weather(
        spark,
        ("spb", "r1", 10, 1, "snow"), ("spb", "r1", 20, 4, "rain"), ("spb", "r1", 30, 4, "rain"),
        ("spb", "r2", 900, 9, "clear"),
    )
    joined = align.bucket_join(events(spark, ("a", "spb", "r1", 899), ("b", "spb", "r1", 1800), ("c", "msc", "r1", 5)), readings)
    row, = joined.collect()
    assert (row["id"], row["temperature"], row["weather_type"]) == ("a", 3.0, "rain")
    assert "scheduler_id" not in joined.columns and "time_interval" not in joined.columns


def test_mode_ties_take_the_lowest_and_nulls_do_not_vote(spark):
    rows = [("tie", "b", "x"), ("tie", "a", "x"), ("nulls", None, "y"), ("nulls", None, None), ("mostly null", None, "z"), ("mostly null", "q", None)]
    frame = spark.createDataFrame(rows, "k string, v string, w string")
    best = {r["k"]: (r["v"], r["w"]) for r in summarize.summarize(frame, ["k"], modes=["v", "w"]).collect()}
    assert best == {"tie": ("a", "x"), "nulls": (None, "y"), "mostly null": ("q", "z")}


def test_summary_numbers_do_not_depend_on_modes(spark):
    frame = spark.range(1000).select(
        (F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 != 0, F.col("id")).alias("x"),
        (F.col("id") % 3).cast("string").alias("v"), (F.col("id") % 11).cast("string").alias("w"),
    )
    kinds = dict(means=["x"], sums=["x"], mins=[])
    with_modes = summarize.summarize(frame, ["k"], means=["x"], modes=["v", "w"], mins=["w"])
    without = frame.groupBy("k").agg(F.avg("x").alias("x"), F.min("w").alias("w_min"), F.mode("v", True).alias("v"), F.mode("w", True).alias("w"))
    expected = {r["k"]: (r["x"], r["v"]) for r in without.collect()}
    assert {r["k"]: (r["x"], r["v"]) for r in with_modes.drop("w").collect()} == expected


def test_group_without_numbers_has_null_mean(spark):
    frame = spark.createDataFrame([("a", None, "m")], "k string, x double, v string")
    assert summarize.summarize(frame, ["k"], means=["x"], modes=["v"]).first()["x"] is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_join_when_one_key_holds_a_third(spark, how):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 97).alias("k"), "id"
    )
    few = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = {r["k"]: r["__copies"] for r in skew.hot_keys(many, ["k"], 100).filter("k is not null").collect()}
    assert hot[0] >= 10 and len(hot) == 1
    split = skew.split_join(many, few, ["k"], how, rows_per_task=100)
    plain = many.join(few, "k", how)
    assert split.columns == plain.columns
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_split_join_spreads_the_hot_key(spark):
    many = spark.range(4000).select(F.lit(1).cast("bigint").alias("k"), "id")
    few = spark.createDataFrame([(1, "x")], "k bigint, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = skew.split_join(many, few, ["k"], rows_per_task=100)
        sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_lookup_repeats_records_and_reports_missing(spark):
    messages = spark.createDataFrame([("r1", "k1", "w"), ("r1", "k1", "w"), ("r2", "gone", "w")], schemas.NOTIFICATION)
    records = spark.createDataFrame([("k1", 7), ("k2", 8)], "key string, payload int")
    found, missing = lookup.lookup_records(messages, records)
    assert [(r["cache_id"], r["payload"]) for r in found.collect()] == [("k1", 7)] * 2
    assert [r["cache_id"] for r in missing.collect()] == ["gone"]


def test_first_sighting_decides_the_run(spark):
    sightings = events(spark, ("a", "spb", "r1", 0), ("b", "spb", "r1", 0)).withColumn("seen_at", F.lit(1)).unionByName(
        events(spark, ("a", "spb", "r2", 0), ("c", "spb", "r2", 0)).withColumn("seen_at", F.lit(2))
    )
    known = spark.createDataFrame([("c",)], "id string")
    fresh = dedup.first_sightings(sightings, known, ["id"], ["seen_at"])
    assert sorted((r["id"], r["scheduler_id"]) for r in fresh.collect()) == [("a", "r1"), ("b", "r1")]


def test_survivor_does_not_depend_on_partitioning(spark):
    frame = spark.range(500).select((F.col("id") % 10).alias("k"), F.lit(1).alias("same"), "id")
    results = [
        sorted(tuple(r) for r in dedup.keep_first(frame.repartition(n), ["k"], ["same"]).collect()) for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]


def test_dedup_limits_rows_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = dedup.keep_first(frame, ["k"], ["id"])._jdf.queryExecution().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_counting_and_deduplication_share_a_partitioning(spark):
    readings = weather(spark, ("spb", "r1", 0, 1, "snow"))
    first = dedup.keep_first(readings, align.RUN_KEYS, ["date"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = align.count_per_run(first, events(spark, ("a", "spb", "r1", 0)), first_reading=F.lit(START))
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
