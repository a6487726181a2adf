"""What the text operators share: table access, word rules, links to components."""

from __future__ import annotations

import builtins
import itertools
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.session import remove, stored, work_path

#: A word is a run of anything but these (fixed by the contract).
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of documents alone, so no other name can clash."""
    return docs.select(*DOCUMENT_COLUMNS)


def word_array(text: Column) -> Column:
    """The words of ``text``; a null text has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS))


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """Value kept while the Python worker process lives.

    Functions that are pickled by value get new globals in each task; what is dear
    to build (a tokenizer, a cache of words) is kept here instead.
    """
    kept = builtins.__dict__.setdefault("_tallycast_worker", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def slices_of(items: list, lengths: list[int], most: int) -> Iterator[slice]:
    """Runs of ``items`` whose lengths add up to ``most`` or little more."""
    begin = total = 0
    for i, length in enumerate(lengths):
        total += length
        if total >= most:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(items):
        yield slice(begin, len(items))


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(v, root)``: each linked vertex and the smallest one it reaches.

    Each round hooks every vertex to its smallest neighbour, follows those pointers
    to their ends and contracts the links; paths shorten at least by half, so the
    rounds grow with the logarithm of the longest path. Minimums combine ahead of
    the shuffle, joins are on single keys that AQE can split, and each step is written
    to the shared folder, where only the last one stays.
    """
    spark, place = links.sparkSession, work_path(links.sparkSession, "components")
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = links.select(low.alias("a"), high.alias("b")).filter("a < b").distinct()
    edges = stored(edges, f"{place}/edges-0")
    found, step = None, 0
    while not edges.isEmpty():
        step += 1
        ends = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).unionAll(
            edges.select(F.col("b").alias("v"), F.col("a").alias("n"))
        )
        hooked = ends.groupBy("v").agg(F.min("n").alias("n")).select("v", F.least("v", "n").alias("root"))
        hooked, followed = _follow(hooked, f"{place}/hooked-{step}")
        if found is None:
            found, kept = hooked, followed
        else:
            up = hooked.select(F.col("v").alias("root"), F.col("root").alias("__up"))
            joined = found.join(up, "root", "left").select("v", F.coalesce("__up", "root").alias("root"))
            last, kept = kept, f"{place}/found-{step}"
            found = stored(joined, kept)
            remove(spark, last)
        left = hooked.select(F.col("v").alias("a"), F.col("root").alias("__ra"))
        right = hooked.select(F.col("v").alias("b"), F.col("root").alias("__rb"))
        moved = edges.join(left, "a").join(right, "b").filter("__ra <> __rb")
        moved = moved.select(F.least("__ra", "__rb").alias("a"), F.greatest("__ra", "__rb").alias("b")).distinct()
        edges = stored(moved, f"{place}/edges-{step}")
        remove(spark, f"{place}/edges-{step - 1}")
        if followed != kept:
            remove(spark, followed)
    remove(spark, f"{place}/edges-{step}")
    if found is None:
        return links.select(F.col("a").alias("v"), F.col("a").alias("root")).limit(0)
    return found


def _follow(pointers: DataFrame, place: str) -> tuple[DataFrame, str]:
    """Replace each root by the root's own root until nothing changes; also where the outcome is.

    Paths are cut to a quarter by two hops before each writing.
    """

    def hop(at: DataFrame) -> DataFrame:
        up = at.filter("v <> root").select(F.col("v").alias("root"), F.col("root").alias("__up"))
        moved = F.col("__up").isNotNull().alias("__moved")
        return at.select("v", "root").join(up, "root", "left").select("v", F.coalesce("__up", "root").alias("root"), moved)

    for turn in itertools.count():
        pointers = stored(hop(hop(pointers)), f"{place}-{turn}")
        if turn:
            remove(pointers.sparkSession, f"{place}-{turn - 1}")
        if pointers.filter("__moved").isEmpty():
            return pointers.drop("__moved"), f"{place}-{turn}"


def filter_late(df: DataFrame, condition: str) -> DataFrame:
    """Rows where the column ``condition`` is true, without moving the filter down.

    A filter on a column is pushed below the projection that makes it, with the whole
    expression written out once per use. A column that the optimizer may not evaluate twice
    keeps it in place.
    """
    kept = df.withColumn("__late", F.monotonically_increasing_id())
    return kept.filter(F.col(condition) & (F.col("__late") >= 0)).drop("__late")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often it is used.

    Column references inside a lambda are replaced by their expressions when plans
    collapse; a lambda variable never is.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(lengths: Column, block: int = 256) -> Column:
    """Inclusive running sums of an array of integers.

    Sums are appended inside blocks and over blocks, so the copying that an append
    costs grows with ``block`` and not with the array.
    """

    def scan(values: Column, start: Column) -> Column:
        kept = F.aggregate(
            values, F.array(start), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
        )
        return F.slice(kept, F.lit(2), F.size(values))

    def sums(values: Column) -> Column:
        count = F.ceil(F.size(values) / F.lit(block)).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), count - 1), lambda b: F.slice(values, b * block + 1, F.lit(block))
        )
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, starts(bs), scan)))

    def starts(bs: Column) -> Column:
        totals = F.transform(bs, lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b))
        return let(totals, lambda t: F.concat(F.array(F.lit(0)), F.slice(scan(t, F.lit(0)), F.lit(1), F.size(t) - 1)))

    none = F.array().cast("array<int>")
    return let(lengths, lambda v: F.when(F.size(v) == 0, none).otherwise(sums(v)))
