"""One row per key, within a batch and across batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import cut_lineage

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of every key under ``order``.

    Rows equal under ``order`` are told apart by a hash of their content, so the
    survivor does not depend on partitioning. Spark plans ``row_number = 1`` with a
    per-task limit ahead of the shuffle: a key with a third of all rows sends one
    row per task.
    """
    content = F.xxhash64(*[F.col(name) for name in df.columns])
    window = Window.partitionBy(*keys).orderBy(*order, content)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def drop_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``seen``.

    Give it rows already unique per key (:func:`keep_first`): the joins then have no
    hot key. ``seen`` is the long history and ``df`` one batch, so ``seen`` is first
    reduced to the keys of the batch. That join can hash the batch and stream the
    history past it, which then is neither sorted nor, if its table is bucketed on
    ``keys``, shuffled.
    """
    known = seen.select(*keys).join(df.select(*keys), list(keys), "left_semi")
    return df.join(known, list(keys), "left_anti").select(*df.columns)


def first_sightings(
    df: DataFrame, seen: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Rows to process from this batch: the first of every key never seen before.

    The first rows are checkpointed, so the batch is evaluated once.
    """
    return drop_seen(cut_lineage(keep_first(df, keys, order)), seen, keys)
