"""Saved models and the champion/challenger rule."""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.session import read_json_if_present

FIRST, BETTER, KEPT = 0, 1, -1

_LEDGER = "version BIGINT, path STRING, decision INT, new_rmse DOUBLE, old_rmse DOUBLE, tz STRING"
_LEDGER_NAMES = [part.split()[0] for part in _LEDGER.split(", ")]


class ModelStore:
    """Versions of a model below one folder.

    Every version has a folder of its own, and a ledger row names it only after it
    is fully written. A reader therefore finds the old version or the new one,
    never a half-written model. The row of a new version is a file of its own that only one
    trainer can create; another one that judged against the same model finds it taken, and
    judges again, against the new model. A missing ledger means "no model yet"; a damaged
    model raises when it is loaded.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def _ledger_path(self) -> str:
        return f"{self.path}/ledger"

    def ledger(self) -> DataFrame | None:
        """All decisions taken, or None before the first."""
        return read_json_if_present(self.spark, self._ledger_path, _LEDGER)

    def current(self) -> tuple[int, str] | None:
        """Version number and path of the model in use."""
        ledger = self.ledger()
        if ledger is None:
            return None
        saved = ledger.filter(F.col("decision") != KEPT)
        newest = saved.agg(F.max(F.struct("version", "path")).alias("top")).first()["top"]
        return None if newest is None else (newest["version"], newest["path"])

    def exists(self) -> bool:
        return self.current() is not None

    def load(self) -> PipelineModel:
        """The model in use."""
        current = self.current()
        if current is None:
            raise FileNotFoundError(f"no model saved in {self.path}")
        return PipelineModel.load(current[1])

    def zone(self) -> str | None:
        """Zone of the calendar parts that the model in use was trained on."""
        current = self.current()
        if current is None:
            return None
        return self.ledger().filter(F.col("path") == current[1]).agg(F.max("tz")).first()[0]

    def promote_if_better(
        self, model: PipelineModel, held_out: DataFrame, label: str = "crashes", tz: str | None = None
    ) -> int:
        """Save ``model`` if it is the first (0) or has lower RMSE than the current
        one on ``held_out`` (1); otherwise, also on a tie, keep the current one (-1).
        """
        path = None
        while True:
            current = self.current()
            champion = None if current is None else PipelineModel.load(current[1])
            new_rmse, old_rmse = compare(model, champion, held_out, label)
            if champion is None:
                decision = FIRST
            else:
                comparable = new_rmse is not None and old_rmse is not None
                decision = BETTER if comparable and new_rmse < old_rmse else KEPT
            version = 1 if current is None else current[0] + (decision == BETTER)
            if decision == KEPT:
                entry = [(version, path or "", decision, new_rmse, old_rmse, tz)]
                self.spark.createDataFrame(entry, _LEDGER).coalesce(1).write.mode("append").json(self._ledger_path)
                return decision
            if path is None:
                # a name of its own: two trainers at once never write one folder
                path = f"{self.path}/versions/{uuid.uuid4().hex}"
                model.write().save(path)
            if self._claim(version, path, decision, new_rmse, old_rmse, tz):
                return decision
            self._await(version)

    def _claim(self, version: int, path: str, decision: int, new_rmse, old_rmse, tz) -> bool:
        """Enter a version in the ledger; False if another trainer has entered it.

        Only one of several can create a file that must not exist yet, on file systems that
        give that promise, as HDFS and local ones do.
        """
        row = dict(zip(_LEDGER_NAMES, (version, path, decision, new_rmse, old_rmse, tz)))
        text = json.dumps({name: value for name, value in row.items() if value is not None})
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._ledger_path}/v{version:06d}.json")
        system = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            out = system.create(place, False)
        except Py4JJavaError as problem:
            if system.exists(place):
                return False
            raise problem
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _await(self, version: int, tries: int = 60) -> None:
        """Wait until the version that another trainer has claimed can be read."""
        for _ in range(tries):
            current = self.current()
            if current is not None and current[0] >= version:
                return
            time.sleep(0.5)
        raise RuntimeError(f"version {version} in {self._ledger_path} was claimed, but never written: remove its file")


def compare(
    challenger: PipelineModel, champion: PipelineModel | None, held_out: DataFrame, label: str = "crashes"
) -> tuple[float, float | None]:
    """RMSE of both models over the same rows, in one pass."""
    columns = held_out.columns
    scored = challenger.transform(held_out).select(*columns, F.col("prediction").alias("__new"))
    errors = [_rmse(label, "__new")]
    if champion is not None:
        scored = champion.transform(scored).select(label, "__new", F.col("prediction").alias("__old"))
        errors.append(_rmse(label, "__old"))
    found = scored.agg(*[e.alias(f"e{i}") for i, e in enumerate(errors)]).first()
    return found[0], (found[1] if champion is not None else None)


def _rmse(label: str, prediction: str):
    error = F.col(label) - F.col(prediction)
    return F.sqrt(F.avg(error * error))
