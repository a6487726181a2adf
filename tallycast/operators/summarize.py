"""Group summaries: sums, means, minima and most frequent values in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_N = "__n"


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    means: Sequence[str] = (),
    modes: Sequence[str] = (),
    sums: Sequence[str] = (),
    mins: Sequence[str] = (),
) -> DataFrame:
    """One row per key, summary columns named as their inputs.

    A mode is the most frequent non-NULL value, the lowest one on a tie, NULL when
    there is none. Values are counted per (key, value) first, with map-side
    combining, and the best count is picked after that. Nothing ever holds the
    values of one group together, however large the group or its variety.
    """
    keys, modes = list(keys), list(modes)
    if not modes:
        return df.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in sums],
            *[F.avg(c).alias(c) for c in means],
            *[F.min(c).alias(c) for c in mins],
        )

    return finish_summary(partial_summary(df, keys, means, modes, sums, mins), keys, means, modes, sums, mins)


def partial_summary(
    df: DataFrame,
    keys: Sequence[str],
    means: Sequence[str] = (),
    modes: Sequence[str] = (),
    sums: Sequence[str] = (),
    mins: Sequence[str] = (),
) -> DataFrame:
    """What :func:`finish_summary` needs of ``df``: some rows per key, to be stored and merged.

    Each value of a mode column has a row with its count. Sums, counts and minima are spread
    over the rows of the first mode column; without any there is one row per key.
    """
    keys, modes = list(keys), list(modes)
    numbers = [
        F.count(F.lit(1)).alias(_N),
        *[F.sum(c).alias(_part("sum", c)) for c in dict.fromkeys([*sums, *means])],
        *[F.count(c).alias(_part("count", c)) for c in means],
        *[F.min(c).alias(_part("min", c)) for c in mins],
    ]
    if not modes:
        return df.groupBy(*keys).agg(*numbers)
    # one grouping set per mode column; the numbers are read off the first set
    flags = [F.grouping(c).alias(_set(c)) for c in modes]
    return df.groupingSets([[*keys, c] for c in modes], *keys, *modes).agg(*flags, *numbers)


def merge_summaries(
    parts: DataFrame,
    keys: Sequence[str],
    means: Sequence[str] = (),
    modes: Sequence[str] = (),
    sums: Sequence[str] = (),
    mins: Sequence[str] = (),
) -> DataFrame:
    """Partial summaries of several sets of rows, as one of all of them."""
    numbers = [
        F.sum(_N).alias(_N),
        *[F.sum(_part("sum", c)).alias(_part("sum", c)) for c in dict.fromkeys([*sums, *means])],
        *[F.sum(_part("count", c)).alias(_part("count", c)) for c in means],
        *[F.min(_part("min", c)).alias(_part("min", c)) for c in mins],
    ]
    return parts.groupBy(*keys, *modes, *[_set(c) for c in modes]).agg(*numbers)


def finish_summary(
    parts: DataFrame,
    keys: Sequence[str],
    means: Sequence[str] = (),
    modes: Sequence[str] = (),
    sums: Sequence[str] = (),
    mins: Sequence[str] = (),
) -> DataFrame:
    """One row per key from a partial summary."""
    first = F.col(_set(modes[0])) == 0 if modes else F.lit(True)

    def total(kind: str, column: str) -> Column:
        return F.sum(F.when(first, F.col(_part(kind, column))))

    return parts.groupBy(*keys).agg(
        *[total("sum", c).alias(c) for c in sums],
        *[F.try_divide(total("sum", c), total("count", c)).alias(c) for c in means],
        *[F.min(F.when(first, F.col(_part("min", c)))).alias(c) for c in mins],
        *[_most_frequent(c).alias(c) for c in modes],
    )


def most_frequent(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value of ``column`` per key."""
    return summarize(df, keys, modes=[column])


def count_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def zero_filled_count(all_keys: DataFrame, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``all_keys`` with the number of matching ``rows``, 0 where there are none.

    Counting comes before the join, so the join sees one row per key on both sides
    and reuses the partitioning of the count.
    """
    counted = count_rows(rows, keys, name)
    joined = all_keys.join(counted, list(keys), "left")
    return joined.select(*all_keys.columns, F.coalesce(F.col(name), F.lit(0)).alias(name))


def root_mean_square_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row, one column ``rmse``."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def any_contains(columns: Sequence[Column], needle: str) -> Column:
    """True where one of ``columns`` contains ``needle``, ignoring case."""
    return reduce(or_, [F.lower(c.cast("string")).contains(needle) for c in columns])


def _most_frequent(column: str) -> Column:
    own_set = (F.col(_set(column)) == 0) & F.col(column).isNotNull()
    ranked = F.struct((-F.col(_N)).alias("order"), F.col(column).alias("value"))
    return F.min(F.when(own_set, ranked)).getField("value")


def _set(column: str) -> str:
    return f"__set_{column}"


def _part(kind: str, column: str) -> str:
    return f"__{kind}_{column}"
