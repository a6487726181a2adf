"""Category dictionaries ordered by frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import cut_lineage

_AT, _PART, _BEFORE, _ROWS = "__at", "__part", "__before", "__rows"
_PART_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def category_index(df: DataFrame, column: str) -> DataFrame:
    """``(column, n, index)``: most frequent value 0, ties in value order, no NULLs.

    The numbering matches what a fitted string indexer assigns, without gathering
    the values in one task or on the driver. Runs a job: the sorted values are
    checkpointed so that both passes see the same partitions.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return number_rows(counted, [F.desc("n"), F.asc(column)], "index")


def number_rows(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add the 0-based position of every row in the global ``order``.

    Rows are range-partitioned and numbered inside their partition; each partition
    then starts where the ones before it end. Only the partition sizes, one row per
    partition, pass through a single task.
    """
    ordered = cut_lineage(df.orderBy(*order).withColumn(_AT, F.monotonically_increasing_id()))
    placed = ordered.withColumn(_PART, F.shiftright(F.col(_AT), _PART_BITS))
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias(_ROWS))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE))
    # broadcast: one row per partition of `ordered`
    numbered = placed.join(F.broadcast(starts), _PART)
    local = F.col(_AT).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return numbered.select(*df.columns, (local + F.col(_BEFORE)).alias(name))
