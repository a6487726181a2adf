"""Starting and draining streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallycast.session import read_json_if_present

_STATE_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Number of state partitions for queries started inside the block.

    AQE does not resize stateful stages and the number is fixed by the first run of
    a checkpoint, so it is chosen for the state expected, not for one batch.
    """
    if count is None:
        yield
        return
    before = spark.conf.get(_STATE_PARTITIONS)
    spark.conf.set(_STATE_PARTITIONS, str(count))
    try:
        yield
    finally:
        spark.conf.set(_STATE_PARTITIONS, before)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that ``checkpoint`` belongs to.

    It is made with the checkpoint and lives in it, so a renewed checkpoint, which counts
    its batches from 0 again, is another stream.
    """
    place = f"{checkpoint.rstrip('/')}/stream_id"
    stored = read_json_if_present(spark, place, "name STRING")
    if stored is None:
        made = spark.createDataFrame([(uuid.uuid4().hex,)], "name STRING").coalesce(1)
        made.write.json(place)
        stored = read_json_if_present(spark, place, "name STRING")
    return stored.first()["name"]


def begin(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start ``writer``: process what is there and stop, or run on ``every`` interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    timed = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return timed.start()


def append_files(stream: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataStreamWriter:
    """Parquet sink; with a checkpoint every row is written exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def per_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    """Run ``work(batch, batch_id)`` on every micro-batch."""
    return stream.writeStream.outputMode(mode).foreachBatch(work)


def drain(query: StreamingQuery) -> None:
    """Wait for an available-now query; its failure is raised here."""
    query.awaitTermination()
