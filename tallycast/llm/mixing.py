"""Mixing sources to target weights along a curriculum.

Each source has a weight that varies over training. Its share of the mix comes from the
plain weights (:func:`source_targets`); its schedule says when the words of that share are
read. A source's documents stand in the order of a hash and are read from the start again
when they run out. Integrating the schedule gives the words demanded up to a time;
inverting that gives the time at which a document's words are reached: its position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.llm.common import document_columns, table, word_array
from tallycast.session import cut_lineage

# Fixed values of the contract.
WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5
MOST_PASSES = 2

#: Rows that are numbered together. A source is cut into ranges of its hash order, at most
#: 65,536 of them, so the sums of a source's ranges fit one task at any size.
ROWS_PER_RANGE = 500


@dataclass(frozen=True)
class Schedule:
    """Relative weight of a source over training, a straight line from ``begin`` to ``end``."""

    begin: float
    end: float


#: Schedules of the sources in turn: early, even, late.
SCHEDULES = (Schedule(1.5, 0.5), Schedule(1.0, 1.0), Schedule(0.5, 1.5))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = MIX_SHARE, most: float = MOST_PASSES) -> DataFrame:
    """``(source, source_size)`` -> the same with ``place`` and ``target``.

    Sources are numbered by code point, null last, and take the weights in turn. A target
    stops at ``most`` times the source's size; what is over goes to the others by weight,
    again and again, which ends where every target is ``min(cap, weight * level)``. With
    sources sorted by cap / weight, those before some place are at their cap, and the level
    follows from running sums: no loop. The table has one row per source.
    """
    total = Window.partitionBy()
    numbered = sizes.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    )
    choice = F.array(*[F.lit(float(w)) for w in weights])
    capped = numbered.withColumns(
        {
            "w": F.get(choice, F.pmod(F.col("place"), F.lit(len(weights)))),
            "cap": F.col("source_size") * F.lit(float(most)),
            "wanted": F.sum("source_size").over(total) * F.lit(float(share)),
        }
    ).withColumn("ratio", F.col("cap") / F.col("w"))
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    level = capped.withColumns(
        {
            "caps": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "rest": F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
        }
    ).withColumn("level", (F.col("wanted") - F.col("caps")) / F.col("rest"))
    # the first source whose cap the level does not reach sets it; none: all are at their cap
    set_by = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(total)
    return level.withColumn("__set", set_by["level"]).select(
        "source",
        "source_size",
        F.col("place"),
        F.when(F.col("__set").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("w") * F.col("__set")))
        .alias("target"),
    )


def order_key(id_column: str) -> Column:
    """Hash that orders a source's documents; the same on every run and engine."""
    return F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))


def _time(demand: Column, place: Column, schedules: tuple[Schedule, ...]) -> Column:
    """Training time in [0, 1] at which a share of a source's demand is reached.

    The share demanded by time t is ``(b t + (e - b) t^2 / 2) / m`` with the line from b to
    e and its mean m; the inverse is the root of that square equation.
    """
    pick = lambda of: F.get(F.array(*[F.lit(float(of(s))) for s in schedules]), F.pmod(place, F.lit(len(schedules))))
    begin, slope = pick(lambda s: s.begin), pick(lambda s: s.end - s.begin)
    mean = pick(lambda s: (s.begin + s.end) / 2)
    root = F.sqrt(F.greatest(F.lit(0.0), begin * begin + 2 * slope * mean * demand))
    return F.when(slope == 0, demand).otherwise((root - begin) / slope)


def mix(
    docs: DataFrame,
    schedules: tuple[Schedule, ...] = SCHEDULES,
    weights=WEIGHTS,
    share: float = MIX_SHARE,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``size, source_size, target, taken, positions`` to ``doc_id, text, source`` rows.

    ``size`` is the number of words (null or empty text: 0). The words a source gives are
    the first ``target`` of its documents laid out in hash order, over and over: ``taken``
    is how many of them a document gives, at most ``most`` times its size. ``positions``
    has the training time in [0, 1] of each pass that takes words from it. Rows with equal
    ids are ordered by size and text hash, so reruns agree; a null source is a source of its
    own; an empty table stays empty. Input columns named like added ones are replaced.

    A source is cut into ranges of its hash order; running sums are taken inside ranges
    and over the sums of ranges, so no task sees a whole source.
    """
    key = order_key("doc_id")
    sized = docs.withColumn("size", F.size(word_array(F.col("text"))).cast("bigint"))
    light = sized.select("source", key.alias("__key"), "size")
    # the leading hash digits split every source alike; the split follows the rows
    rows = cut_lineage(
        light.groupBy("source", F.substring("__key", 1, 4).alias("__piece")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
        )
    )
    widest = rows.groupBy("source").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    digits = 1
    while digits < 4 and widest / 16**digits > rows_per_range:
        digits += 1
    piece = F.substring("__key", 1, digits)
    ranges = rows.groupBy("source", F.substring("__piece", 1, digits).alias("__piece")).agg(F.sum("size").alias("size"))
    before = Window.partitionBy("source").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("source", "__piece", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("__before"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    plan = starts.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("__source"), F.col("s.__piece").alias("__start_piece"), "__before", "source_size", "place", "target"
    )
    inside = (
        Window.partitionBy("source", "__piece")
        .orderBy("__key", "doc_id", "size", F.xxhash64("text"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "positions")]
    placed = sized.select(*kept, "size", key.alias("__key"), F.substring(key, 1, digits).alias("__piece"))
    local = placed.withColumn("__at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # one row per range of a source: Spark broadcasts it when it is small
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("__piece") == F.col("__start_piece"))
    joined = local.join(plan, same)
    at = F.col("__at") + F.col("__before")
    passes = range(MOST_PASSES)
    wanted = F.round("target").cast("bigint")
    gives = [
        F.least(F.col("size"), F.greatest(F.lit(0).cast("bigint"), wanted - at - F.col("source_size") * p))
        for p in passes
    ]
    middle = at + F.col("size") / 2
    times = [
        F.when(
            gives[p] > 0,
            _time(
                F.least(F.lit(1.0), (middle + F.col("source_size") * p) / F.col("target")), F.col("place"), schedules
            ),
        )
        for p in passes
    ]
    taken = gives[0]
    for more in gives[1:]:
        taken = taken + more
    return joined.select(
        *kept,
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        F.array_compact(F.array(*times)).alias("positions"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per document and pass with its ``position``, range-sorted by position."""
    read = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return read.orderBy("position", "doc_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text", "source")
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.round(F.get("positions", F.lit(0)), 9).alias("position"),
        F.size("positions").alias("passes"),
    ).orderBy("position", "doc_id")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in training order, once per pass that takes words from them."""
    rows = document_columns(docs)
    return training_order(mix(rows)).select(*rows.columns)
