"""Tuning of the forest that predicts crashes per hour."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame

from tallycast.ml.features import SPLIT_SEED, check_bins, feature_pipeline, labelled, stable_split, unscorable

# ---- fixed values: the search grid
TREE_COUNTS = (2, 3, 4, 5)
TREE_DEPTHS = (5, 6, 7, 8)

#: Bins of a tree: at least the values of the largest category and one more.
MAX_BINS = 128

ROW_KEYS = ("city_name", "year", "day_of_year", "hour")


@dataclass
class Trained:
    """A model that carries its encoders, and the rows held out from training."""

    model: PipelineModel
    held_out: DataFrame
    metrics: list[float]
    #: Rows that lack a number and so are in no part.
    left_out: int = 0
    #: ``(trees, depth, forest)`` of every candidate, in the order of ``metrics``.
    candidates: list[tuple[int, int, RandomForestRegressionModel]] | None = None
    #: The part of the training rows that the candidates were judged on.
    validation: DataFrame | None = None


@dataclass
class Tuned:
    """The best forest of a grid, and what the others came to on the validation rows."""

    best: RandomForestRegressionModel
    metrics: list[float]
    candidates: list[tuple[int, int, RandomForestRegressionModel]]


def tune_forest(
    train: DataFrame,
    validation: DataFrame,
    max_bins: int = MAX_BINS,
    tree_counts: Sequence[int] = TREE_COUNTS,
    depths: Sequence[int] = TREE_DEPTHS,
    seed: int = SPLIT_SEED,
    parallelism: int = 4,
) -> Tuned:
    """Forest of the grid with the lowest RMSE on ``validation``, fitted again on all rows.

    Candidates are fitted ``parallelism`` at a time so that small fits do not leave the
    cluster idle. The first of equal ones wins.
    """
    forest = RandomForestRegressor(seed=seed, maxBins=max_bins)
    pairs = list(product(tree_counts, depths))
    grid = [{forest.numTrees: trees, forest.maxDepth: depth} for trees, depth in pairs]
    evaluator = RegressionEvaluator(metricName="rmse")
    fitting = forest.fitMultiple(train, grid)

    def fit(_: int) -> tuple[int, RandomForestRegressionModel, float]:
        place, model = next(fitting)
        return place, model, evaluator.evaluate(model.transform(validation))

    with ThreadPool(min(parallelism, len(pairs))) as pool:
        found = sorted(pool.map(inheritable_thread_target(train.sparkSession)(fit), range(len(pairs)), 1), key=lambda f: f[0])
    metrics = [rmse for _, _, rmse in found]
    best = forest.fit(train.unionByName(validation), grid[metrics.index(min(metrics))])
    return Tuned(best, metrics, [(*pair, model) for pair, (_, model, _) in zip(pairs, found)])


def train_forest(
    hourly: DataFrame,
    keys: Sequence[str] = ROW_KEYS,
    ratio: float = 0.8,
    handle_invalid: str = "keep",
    seed: int = SPLIT_SEED,
    max_bins: int = MAX_BINS,
    **tuning,
) -> Trained:
    """Fit encoders on ``hourly``, tune on its training part, keep the rest aside.

    The encoders are fitted once, outside the grid, and saved with the forest, so
    scoring uses the codes of training. Runs jobs that read ``hourly`` several
    times: give it a stored table or a frame whose lineage is cut.
    """
    features = feature_pipeline(handle_invalid, missing_numbers="skip").fit(hourly)
    check_bins(features, max_bins)
    left_out = unscorable(features, hourly).first()["dropped"]
    train, held_out = stable_split(hourly, keys, ratio, seed)
    # another seed: rows are judged by a split of their own
    parts = [part.persist(StorageLevel.MEMORY_AND_DISK) for part in stable_split(train, keys, ratio, seed + 1)]
    tuned = tune_forest(*[labelled(features, part) for part in parts], max_bins, seed=seed, **tuning)
    for part in parts:
        part.unpersist()
    model = PipelineModel([*features.stages, tuned.best])
    return Trained(model, held_out, tuned.metrics, left_out, tuned.candidates, parts[1])
