import math
import random

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallycast.ml import expression, features, registry, training
from tallycast.ml.scoring import score

SCHEMA = (
    "city_name string, hour int, crashes bigint, humidity double, pressure double, temperature double, "
    "wind_speed double, month int, weekday string, weather_type string, wind_direction string, year int, day_of_year int"
)


def hourly(spark, cities=("spb", "spb2", "msc"), rows=300):
    pick = random.Random(7)
    days = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    values = []
    for i in range(rows):
        hour = 1 + i % 24
        values.append((
            cities[i % len(cities)], hour, 10 if hour > 12 else pick.randrange(3), pick.random(), 740.0, float(i % 30), 1.0,
            1, days[i % 7], "snow" if i % 3 else "rain", "N" if i % 2 else "S", 2024, 1 + i // 24,
        ))
    return spark.createDataFrame(values, SCHEMA)


@pytest.fixture(scope="module")
def trained(spark):
    return training.train_forest(hourly(spark), tree_counts=(2, 3), depths=(5,))


def test_defaults_of_the_search(spark):
    assert training.TREE_COUNTS == (2, 3, 4, 5) and training.TREE_DEPTHS == (5, 6, 7, 8)
    assert len(features.FEATURE_ORDER) == 10


def test_tuning_tries_every_candidate_and_learns(spark, trained):
    assert len(trained.metrics) == 2
    rmse, none = registry.compare(trained.model, None, trained.held_out)
    assert none is None and rmse < 3


def test_split_does_not_depend_on_partitioning(spark):
    rows = hourly(spark)
    train, test = features.stable_split(rows, training.ROW_KEYS)
    other, _ = features.stable_split(rows.repartition(5).orderBy(F.rand()), training.ROW_KEYS)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(train) == key(other)
    assert train.count() + test.count() == 300 and 30 < test.count() < 95
    a, b = features.random_split(rows)
    assert a.count() + b.count() == 300


def test_scoring_uses_the_codes_of_training(spark, trained):
    """Scoring rows of one city alone must not renumber the cities."""
    indexer = trained.model.stages[0]
    labels = dict(zip(features.CATEGORIES, indexer.labelsArray))["city_name"]
    only = hourly(spark).filter("city_name = 'msc'")
    codes = {r["city_index"] for r in trained.model.transform(only).select("city_index").distinct().collect()}
    assert codes == {float(list(labels).index("msc"))}


def test_saved_model_scores_the_same(spark, trained, tmp_path):
    store = registry.ModelStore(spark, str(tmp_path / "m"))
    assert not store.exists()
    with pytest.raises(FileNotFoundError):
        store.load()
    assert store.promote_if_better(trained.model, trained.held_out) == registry.FIRST
    rows = hourly(spark).select("city_name", "humidity", F.col("pressure").cast("int").alias("pressure"), "temperature", "wind_speed",
                                "weather_type", "wind_direction", F.expr("make_timestamp(2024, 1, 1, hour - 1, 0, 0)").alias("date"))
    key = lambda model: sorted(tuple(r) for r in score(model, rows).collect())
    assert key(trained.model) == key(store.load()) and len(key(trained.model)) == 300


def test_unseen_and_missing_categories_are_scored_by_default(spark, trained):
    row = spark.createDataFrame([("ekb", 0.5, 740, 1, 1.0, None, "N")], "city_name string, humidity double, pressure int, temperature int, wind_speed double, weather_type string, wind_direction string")
    row = row.withColumn("date", F.expr("timestamp'2024-01-01 00:10:00'"))
    assert score(trained.model, row).count() == 1
    skipping = training.train_forest(hourly(spark), handle_invalid="skip", tree_counts=(2,), depths=(2,))
    assert score(skipping.model, row).count() == 0


def test_dropped_rows_are_reported(spark):
    rows = hourly(spark)
    broken = rows.withColumn("humidity", F.when(F.col("hour") != 3, F.col("humidity"))).withColumn(
        "city_name", F.when(F.col("hour") == 4, "ekb").otherwise(F.col("city_name")))
    for invalid, hours in [("keep", (3,)), ("skip", (3, 4))]:
        fitted = features.feature_pipeline(invalid, "skip").fit(rows)
        expected = broken.filter(F.col("hour").isin(*hours)).count()
        report = features.unscorable(fitted, broken).first()
        assert (report["rows"], report["dropped"]) == (300, expected)
        assert fitted.transform(broken).count() == 300 - expected


def test_more_than_32_categories(spark):
    many = hourly(spark, cities=[f"c{i}" for i in range(40)], rows=400)
    result = training.train_forest(many, tree_counts=(2,), depths=(3,))
    assert not math.isnan(result.metrics[0])
    with pytest.raises(ValueError, match="city_name has 40 values; max_bins=40"):
        training.train_forest(many, max_bins=40, tree_counts=(2,), depths=(3,))


def test_a_missing_number_fails_unless_told_otherwise(spark):
    rows = hourly(spark)
    broken = rows.withColumn("humidity", F.when(F.col("hour") != 3, F.col("humidity")))
    with pytest.raises(Exception, match="null"):
        features.feature_pipeline().fit(rows).transform(broken).collect()
    assert training.train_forest(broken, tree_counts=(2,), depths=(2,)).left_out == broken.filter("humidity is null").count() > 0


class Fixed:
    """A model that always predicts the same number."""

    def __init__(self, value):
        self.value = value

    def transform(self, df):
        return df.withColumn("prediction", F.lit(float(self.value)))


@pytest.mark.parametrize("challenger, champion, expected", [(1, 2, True), (2, 1, False), (1, 1, False)])
def test_promotion_needs_strictly_lower_rmse(spark, challenger, champion, expected):
    held_out = spark.createDataFrame([(0,), (1,)], "crashes bigint")
    new, old = registry.compare(Fixed(challenger), Fixed(champion), held_out)
    assert (new < old) is expected


def test_promotion_ledger(spark, trained, tmp_path):
    store = registry.ModelStore(spark, str(tmp_path / "m"))
    weak = training.train_forest(hourly(spark), tree_counts=(2,), depths=(0,))
    decisions = [store.promote_if_better(m, trained.held_out) for m in (weak.model, weak.model, trained.model, weak.model)]
    assert decisions == [registry.FIRST, registry.KEPT, registry.BETTER, registry.KEPT]
    assert store.current()[0] == 2 and store.ledger().count() == 4


def test_damaged_model_raises(spark, trained, tmp_path):
    store = registry.ModelStore(spark, str(tmp_path / "m"))
    store.promote_if_better(trained.model, trained.held_out)
    (tmp_path / "m" / "versions").rename(tmp_path / "m" / "elsewhere")
    assert store.exists()
    with pytest.raises(Exception):
        store.load()


def test_another_engine_computes_the_same_scores_from_the_text(spark, trained):
    rows = hourly(spark).withColumn("weather_type", F.expr("if(hour = 3, null, if(hour = 4, 'it''s hail', weather_type))"))
    rows = rows.withColumn("n", F.monotonically_increasing_id())
    ours = {r["n"]: r["prediction"] for r in trained.model.transform(rows).collect()}
    frame = rows.toPandas()  # noqa: F841, read by name
    theirs = dict(duckdb.sql(expression.query_sql(trained.model, "frame", "n")).fetchall())
    assert theirs == ours and len(set(ours.values())) > 5
    again = expression.predict_by_sql(trained.model, rows).collect()
    assert {r["n"]: r["prediction"] for r in again} == ours
    assert "features" not in again[0].asDict() and "city_index" not in again[0].asDict()


def test_rows_that_lack_a_number_have_no_score(spark, trained):
    row = hourly(spark).limit(1).withColumn("humidity", F.lit(None).cast("double"))
    assert expression.predict_by_sql(trained.model, row).first()["prediction"] is None


def test_the_winner_follows_from_predictions_of_the_validation_rows(spark, trained):
    found = []
    for trees, depth, forest in trained.candidates:
        model = PipelineModel([*trained.model.stages[:-1], forest])
        assert (forest.getNumTrees, depth) == (trees, 5)
        found.append(registry.compare(model, None, trained.validation)[0])
    assert found == pytest.approx(trained.metrics)
    assert trained.model.stages[-1].getNumTrees == trained.candidates[found.index(min(found))][0]
    assert 0 < trained.validation.count() < 100


def formula(text):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({text} AS DOUBLE) AS prediction FROM __THIS__")])


@pytest.mark.parametrize("other, decision, versions", [("crashes + 2", 1, [1, 2, 3]), ("crashes + 1", -1, [1, 2])])
def test_two_trainers_at_once_never_enter_one_version(spark, tmp_path, monkeypatch, other, decision, versions):
    """Both judge against version 1; one enters version 2 while the other saves its model."""
    held_out = spark.createDataFrame([(3,), (5,)], "crashes int")
    one, two = (registry.ModelStore(spark, str(tmp_path / "m")) for _ in range(2))
    assert one.promote_if_better(formula("crashes + 9"), held_out) == registry.FIRST
    claim, taken = registry.ModelStore._claim, []

    def late(store, *args):
        if store is one and not taken:
            taken.append(two.promote_if_better(formula(other), held_out))
        return claim(store, *args)

    monkeypatch.setattr(registry.ModelStore, "_claim", late)
    assert one.promote_if_better(formula("crashes + 1"), held_out) == decision and taken == [1]
    saved = one.ledger().filter("decision <> -1").collect()
    assert sorted(r["version"] for r in saved) == versions
    old = {r["version"]: r["old_rmse"] for r in saved}
    assert old[2] == 9 and (decision == -1 or old[3] == 2)
