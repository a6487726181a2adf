"""Stored result tables: delimited text, parquet predictions, seen ids."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast import schemas
from tallycast.operators.serve import END_DAY, end_day
from tallycast.session import cut_lineage, read_json_if_present, remove

_CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def append_csv(df: DataFrame, path: str, mode: str = "append", header: bool = True) -> None:
    """Add ``df`` to a delimited-text table; times keep their microseconds."""
    writer = df.write.mode(mode).option("header", header).option("timestampFormat", _CSV_TIME)
    writer.csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    infer: bool = False,
    sep: str = ",",
) -> DataFrame:
    """Read a delimited-text table.

    With ``schema`` the columns are typed as declared. Otherwise all are text, or
    typed from the data with ``infer``, which reads the table once more.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def append_predictions(predictions: DataFrame, path: str, mode: str = "append") -> None:
    """Store predictions, one row each, partitioned by the day they end.

    All four fields are required; a missing one fails the write. The rebalance hint
    lets AQE size the files and split a day that holds most of the rows.
    """
    complete = predictions.select(*[_required(name) for name in schemas.PREDICTION.names])
    stored = complete.withColumn(END_DAY, end_day(F.col("endDate")))
    stored.hint("rebalance", END_DAY).write.mode(mode).partitionBy(END_DAY).parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions with their partition column, whatever batches wrote them."""
    stored = T.StructType([*schemas.PREDICTION.fields, T.StructField(END_DAY, T.DateType())])
    return spark.read.schema(stored).parquet(path).select(*stored.names)


def _required(name: str) -> Column:
    problem = F.raise_error(F.lit(f"prediction without {name}"))
    return F.coalesce(F.col(name), problem).alias(name)


class SeenIds:
    """Ids processed so far, found again by the id alone, whatever else a copy carries.

    Ids are dealt to a fixed number of buckets by their hash. Inside a bucket every batch of
    every stream has a part of its own, sorted by id and with a Bloom filter: a batch that is
    run again replaces its ids and ignores what it wrote itself, and a stream that starts
    anew, or another one, never meets the parts of the others. A batch of up to ``_PUSHED``
    ids reads their buckets alone and hands the ids to the scan, which then skips the
    files that hold none of them; a larger one has ids in about every file. ``day`` is that of an id in UTC and only says when the id
    may be forgotten.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self._buckets = spark, path.rstrip("/"), buckets
        self._fixed: int | None = None

    @property
    def _ids(self) -> str:
        return f"{self.path}/ids"

    def _layout(self, spark: SparkSession) -> int:
        """The number of buckets, which the first part written fixes for good."""
        if self._fixed is not None:
            return self._fixed
        place = f"{self.path}/layout"
        stored = read_json_if_present(spark, place, "buckets INT")
        if stored is None:
            spark.createDataFrame([(self._buckets,)], "buckets INT").coalesce(1).write.json(place)
            stored = read_json_if_present(spark, place, "buckets INT")
        self._fixed = stored.agg(F.min("buckets")).first()[0]
        return self._fixed

    def ids(self, spark: SparkSession | None = None) -> DataFrame:
        """All rows ``(id, day, stream, level, batch, bucket)`` that are not forgotten."""
        spark = spark or self.spark
        stored, horizon = self._stored(spark), self.horizon(spark)
        return stored if horizon is None else stored.filter(F.col("day").isNull() | (F.col("day") >= F.lit(horizon)))

    def _stored(self, spark: SparkSession) -> DataFrame:
        """All rows, forgotten ones too."""
        try:
            return spark.read.schema(_SEEN).parquet(self._ids)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _SEEN)

    def known(self, ids: DataFrame, stream: str, batch: int) -> DataFrame:
        """Ids among which are all that ``ids`` shares with what other batches remembered.

        ``ids`` is evaluated once more: give it a stored table.
        """
        spark = ids.sparkSession
        wanted = ids.select(F.col("id").cast("string").alias("id")).filter("id is not null")
        own = (F.col("stream") == stream) & (F.col("batch") >= batch)
        others = self.ids(spark).filter(~own)
        few = wanted.select("id", _bucket(self._layout(spark))).limit(_PUSHED + 1).collect()
        if len(few) <= _PUSHED:
            if int(spark.conf.get(IN_LIST)) < _PUSHED:
                spark.conf.set(IN_LIST, str(_PUSHED))  # else Spark looks at the least and greatest alone
            buckets, names = (sorted({row[c] for row in few}) for c in ("bucket", "id"))
            others = others.filter(F.col("bucket").isin(*buckets) & F.col("id").isin(*names) if few else F.lit(False))
        return others.select("id")

    def remember(self, ids: DataFrame, stream: str, batch: int) -> None:
        """Store the ``(id, day)`` rows of a batch, in place of what it stored before.

        ``ids`` has to come from a written copy of the batch, not from this table.
        """
        self._write(ids, stream, 0, batch)

    def _write(self, ids: DataFrame, stream: str, level: int, batch: int) -> None:
        rows = ids.select(F.col("id").cast("string").alias("id"), F.col("day").cast("date").alias("day"))
        rows = rows.filter("id is not null").withColumn("bucket", _bucket(self._layout(ids.sparkSession)))
        # the rebalance hint lets AQE size the files
        placed = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "id")
        writer = placed.write.mode("overwrite").partitionBy("bucket").option("parquet.bloom.filter.enabled#id", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{self._ids}/stream={stream}/level={level}/batch={batch}")

    def compact(self, stream: str, before: int) -> None:
        """Put the parts of the batches of ``stream`` before number ``before`` into one.

        For batches that are never run again. Forgotten ids are left out. The merged part is
        complete before the others are removed; stopping between the two leaves repeats,
        which do no harm.
        """
        old = (F.col("stream") == stream) & (F.col("batch") < before)
        # parts of which every id is forgotten go too
        parts = sorted(tuple(r) for r in self._stored(self.spark).filter(old).select("level", "batch").distinct().collect())
        if len(parts) < 2:
            return
        last = max(batch for _, batch in parts)
        level = 1 + max(level for level, _ in parts)
        merged = self.ids().filter(old).groupBy("id").agg(F.max("day").alias("day"))
        self._write(cut_lineage(merged), stream, level, last)
        for part_level, batch in parts:
            remove(self.spark, f"{self._ids}/stream={stream}/level={part_level}/batch={batch}")

    def forget(self, before: date) -> None:
        """From now on ids of days before ``before`` count as new; ids without a day stay.

        A day once forgotten stays so. The rows go with the next :meth:`compact`.
        """
        horizon = self.horizon(self.spark)
        if horizon is None or before > horizon:
            row = self.spark.createDataFrame([(before,)], "day DATE").coalesce(1)
            row.write.mode("append").json(f"{self.path}/horizon")

    def horizon(self, spark: SparkSession | None = None) -> date | None:
        """Days before this one are forgotten."""
        stored = read_json_if_present(spark or self.spark, f"{self.path}/horizon", "day DATE")
        return None if stored is None else stored.agg(F.max("day")).first()[0]


_SEEN = "id STRING, day DATE, stream STRING, level INT, batch BIGINT, bucket INT"
#: Ids that a batch hands to the scan of the stored ones; more are joined only.
_PUSHED = 200
#: Values of an IN list that Spark hands to the Parquet reader one by one.
IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket")
