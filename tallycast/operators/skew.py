"""Joins of many rows to few when single keys may hold a large share of the rows.

For plans that AQE cannot split by itself; the operators here are shaped so that it can.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a single join task takes before the key is split.
ROWS_PER_TASK = 2_000_000

#: Slices for rows whose key is NULL; they match nothing, so any number is right.
_NULL_SLICES = 4096

_SALT, _COPIES = "__salt", "__copies"


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and how many slices they need.

    At most ``count(df) / rows_per_task`` keys can qualify, so the result is small
    whatever the data: a trillion rows give at most half a million keys.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(_COPIES))
        .filter(F.col(_COPIES) > rows_per_task)
        .withColumn(_COPIES, F.ceil(F.col(_COPIES) / F.lit(rows_per_task)).cast("int"))
    )


def split_join(
    many: DataFrame,
    few: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``many`` to ``few`` (``inner`` or ``left``), spreading hot keys of ``many``.

    Rows of a hot key are divided into slices by a hash of their content, and the
    rows of ``few`` with that key are copied once per slice. Other keys are joined
    as they are. The hash, unlike a random number, is the same when a lost task is
    run again. Columns other than ``keys`` must have different names.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"split_join does inner and left joins, not {how!r}")
    keys = list(keys)
    hot = hot_keys(many, keys, rows_per_task)

    no_key = reduce(or_, [F.col(key).isNull() for key in keys])
    slices = F.when(no_key, _NULL_SLICES).otherwise(F.coalesce(F.col(_COPIES), F.lit(1)))
    content = F.xxhash64(*[F.col(name) for name in many.columns])
    sliced = many.join(hot, keys, "left").select(*many.columns, F.pmod(content, slices).alias(_SALT))

    copies = F.coalesce(F.col(_COPIES), F.lit(1)).cast("bigint")
    copied = few.join(hot, keys, "left").select(
        *few.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)).alias(_SALT)
    )
    return sliced.join(copied, [*keys, _SALT], how).drop(_SALT)
