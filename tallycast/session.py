"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_TARGET_PARTITION_BYTES = 128 * 1024 * 1024

#: Shuffled bytes of a join side that may be hashed. The merged partition size must
#: not exceed it, or Spark never takes the hash join.
_HASHED_BYTES = 64 * 1024 * 1024

#: RocksDB keeps streaming state off the JVM heap, so state may outgrow memory.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "tallycast",
    master: str | None = None,
    expected_input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators are designed for.

    ``expected_input_bytes`` sizes the shuffle: AQE merges partitions that come
    out small but cannot split an evenly overfull one, so the starting number has
    to grow with the data.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_HASHED_BYTES),
        # at run time, hash a join side whose partitions all turn out small; sort otherwise
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(_HASHED_BYTES),
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        # a commit then uploads the changes of its batch, not a snapshot of the state
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # one RocksDB instance per stream-stream join partition in place of four
        "spark.sql.streaming.join.stateFormatVersion": "3",
    }
    if expected_input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(expected_input_bytes))
    settings.update(conf or {})

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, floor: int = 200) -> int:
    """Shuffle partition count that keeps a partition near 128 MiB."""
    return max(floor, -(-input_bytes // _TARGET_PARTITION_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder; on a
    cluster such a folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallycast-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{shared_folder(spark)}/tallycast/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    folder = shared_folder(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there.

    A checkpoint keeps the size Spark estimated for its plan, and a join's estimate is the
    product of both sides'. Where each round joins the outcome of the last with itself, the
    estimates get millions of digits, which fill the driver. The size of files is known.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_json_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """JSON table at ``path``, None when nothing was written there yet.

    Spark logs a warning with a stack trace for a missing path; it has no effect.
    """
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
