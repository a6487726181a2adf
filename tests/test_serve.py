from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.functions import wording
from tallycast.operators import ranking, rollup, serve, summarize
from tallycast.sources import tables

NOW = datetime(2024, 1, 21, 12)


def predictions(spark, *rows):
    return spark.createDataFrame([(c, n, end - timedelta(hours=1), end) for c, n, end in rows], schemas.PREDICTION)


def test_prediction_rows_round_half_up(spark):
    scored = spark.createDataFrame([("spb", v, NOW) for v in (2.5, -2.5, 0.49, None)], "city_name string, prediction double, date timestamp")
    rows = serve.prediction_rows(scored)
    assert rows.schema.names == schemas.PREDICTION.names
    assert [r["crashes"] for r in rows.collect()] == [3, -3, 0, None]
    assert all(r["endDate"] - r["startDate"] == timedelta(hours=1) for r in rows.collect())


def test_listing_is_half_open_and_latest_first(spark):
    edges = [NOW, NOW - timedelta(microseconds=1), NOW - timedelta(days=10), NOW - timedelta(days=10, microseconds=1)]
    stored = predictions(spark, *[("spb", i, end) for i, end in enumerate(edges)])
    assert [r["crashes"] for r in serve.recent_predictions(stored, NOW).collect()] == [1, 2]


def test_listing_prunes_stored_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.append_predictions(predictions(spark, *[("spb", d, NOW - timedelta(days=d)) for d in range(1, 30)]), path)
    listed = serve.recent_predictions(tables.read_predictions(spark, path), NOW)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(end_day" in plan and listed.count() == 10
    assert serve.recent_predictions(tables.read_predictions(spark, path)).count() == 0


@pytest.mark.parametrize(
    "count, right, compat",
    [(0, "many", "many"), (1, "one", "one"), (2, "few", "few"), (5, "many", "many"), (11, "many", "one"), (12, "many", "many"),
     (21, "one", "one"), (22, "few", "many"), (102, "few", "few"), (111, "many", "one"), (112, "many", "many")],
)
def test_crash_word(spark, count, right, compat):
    words = {"one": wording.CRASH_ONE, "few": wording.CRASH_FEW, "many": wording.CRASH_MANY}
    row = spark.range(1).select(wording.crash_word(F.lit(count)), wording.crash_word(F.lit(count), compat=True)).first()
    assert tuple(row) == (words[right], words[compat])


def test_display_and_search(spark):
    stored = predictions(spark, ("spb", 1, NOW), ("msc", 2, NOW), ("ekb", 5, NOW))
    shown = serve.display_predictions(stored)
    assert [tuple(r) for r in shown.filter("city = 'ekb'").collect()] == [("ekb", "5 аварий", "21.01.2024 11:00:00", "21.01.2024 12:00:00")]
    assert [r["city"] for r in serve.search_any(shown, " МОСК ").collect()] == ["Москва"]
    assert serve.search_any(shown, "12:00").count() == 3
    assert serve.search_any(shown, "  ").count() == 3
    assert serve.search_any(shown, "100%").count() == 0
    local = serve.display_predictions(stored, tz="Europe/Moscow").first()
    assert local["endDate"] == "21.01.2024 15:00:00"


def test_rollup_keeps_years_apart_unless_asked(spark):
    rows = [("spb", n, datetime(y, 1, 8, 10, m), 0.5, 740, 1, "snow", "N", 1.0) for y, m, n in [(2023, 0, 1), (2024, 0, 2), (2024, 30, 4)]]
    counts = spark.createDataFrame(rows, schemas.RUN_COUNT)
    apart = rollup.calendar_rollup(counts)
    assert apart.columns == ["city_name", "hour", "crashes", "humidity", "pressure", "temperature", "wind_speed", "month", "weekday", "weather_type", "wind_direction"]
    assert sorted((r["crashes"], r["weekday"]) for r in apart.collect()) == [(1, "Sun"), (6, "Mon")]
    merged = rollup.calendar_rollup(counts, by_year=False).collect()
    assert [(r["crashes"], r["weekday"]) for r in merged] == [(7, "Mon")]


def test_rollup_hour_follows_the_zone(spark):
    counts = spark.createDataFrame([("spb", 1, datetime(2024, 1, 1, 21, 30), 0.5, 740, 1, "snow", "N", 1.0)], schemas.RUN_COUNT)
    row = rollup.calendar_rollup(counts, tz="Europe/Moscow").first()
    assert (row["hour"], row["weekday"]) == (24, "Tue")


def test_rmse_ignores_missing_values(spark):
    frame = spark.createDataFrame([(1.0, 3.0), (1.0, 1.0), (None, 9.0)], "a double, b double")
    assert summarize.root_mean_square_error(frame, "a", "b").first()["rmse"] == pytest.approx(2**0.5)


def test_category_index_equals_a_string_indexer(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer

    frame = spark.range(5000).select(F.when(F.col("id") % 11 != 0, (F.col("id") * F.col("id") % 257).cast("string")).alias("v"))
    ours = {r["v"]: r["index"] for r in ranking.category_index(frame, "v").collect()}
    labels = StringIndexer(inputCol="v", outputCol="i", handleInvalid="skip").fit(frame).labels
    assert ours == {v: i for i, v in enumerate(labels)}


def test_numbering_is_global_over_many_partitions(spark):
    frame = spark.range(10000).select((F.col("id") * 7919 % 10007).alias("x")).repartition(16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = ranking.number_rows(frame, ["x"], "n")
        assert numbered.filter("n between 0 and 9999").select("n").distinct().count() == 10000
        rows = [tuple(r) for r in numbered.orderBy("x").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [n for _, n in rows] == list(range(10000))
