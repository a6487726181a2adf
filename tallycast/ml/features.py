"""Hourly features -> vectors, and reproducible splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: indexed columns and the order of the vector
CATEGORIES = {
    "city_name": "city_index",
    "weekday": "weekday_index",
    "weather_type": "weather_type_index",
    "wind_direction": "wind_direction_index",
}
FEATURE_ORDER = (
    "city_index",
    "humidity",
    "pressure",
    "temperature",
    "wind_speed",
    "hour",
    "weekday_index",
    "month",
    "weather_type_index",
    "wind_direction_index",
)
SPLIT_SEED = 2022


def feature_pipeline(handle_invalid: str = "keep", missing_numbers: str = "error") -> Pipeline:
    """Indexers and assembler.

    ``handle_invalid='keep'`` gives unseen and absent categories a code of their
    own, so the row is still scored; ``'skip'`` leaves such rows out. Rows lacking a
    number cannot be scored: they fail, or are left out where ``missing_numbers`` is
    ``'skip'``; :func:`unscorable` counts them.
    """
    indexer = StringIndexer(
        inputCols=list(CATEGORIES), outputCols=list(CATEGORIES.values()), handleInvalid=handle_invalid
    )
    assembler = VectorAssembler(inputCols=list(FEATURE_ORDER), outputCol="features", handleInvalid=missing_numbers)
    return Pipeline(stages=[indexer, assembler])


def check_bins(features: PipelineModel, max_bins: int) -> None:
    """Fail if a category has more values, unseen code included, than a tree may have bins.

    The number is the caller's: it also sets how finely numbers are binned, so it must
    not change because a category appears.
    """
    for column, labels in zip(CATEGORIES, features.stages[0].labelsArray):
        if len(labels) + 1 > max_bins:
            raise ValueError(f"{column} has {len(labels)} values; max_bins={max_bins} is too small for them")


def labelled(features: PipelineModel, df: DataFrame, label: str = "crashes") -> DataFrame:
    """``features`` and ``label`` (double)."""
    return features.transform(df).select("features", F.col(label).cast("double").alias("label"))


def stable_split(
    df: DataFrame, keys: Sequence[str], ratio: float = 0.8, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of ``keys``: the same rows whatever the partitioning or order."""
    place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000))
    inside = place < int(ratio * 1_000_000)
    return df.filter(inside), df.filter(~inside)


def random_split(df: DataFrame, ratio: float = 0.8, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split; depends on partitioning and row order."""
    train, test = df.randomSplit([ratio, 1 - ratio], seed=seed)
    return train, test


def unscorable(features: PipelineModel, df: DataFrame) -> DataFrame:
    """One row, ``rows`` and ``dropped``: what the pipeline would leave out of ``df``."""
    numbers = [c for c in FEATURE_ORDER if c not in CATEGORIES.values()]
    lost = F.greatest(*[F.col(c).isNull() for c in numbers])
    indexer = features.stages[0]
    if indexer.getHandleInvalid() == "skip":
        # encoded with a code for everything unknown: the one after the last label
        keeping = indexer.copy().setHandleInvalid("keep")
        df = keeping.transform(df)
        codes = zip(CATEGORIES.values(), keeping.labelsArray)
        lost = F.greatest(lost, *[F.col(code) >= len(labels) for code, labels in codes])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(lost).alias("dropped"))
