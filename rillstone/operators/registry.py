"""Model registry: a folder per model and version, and an append-only log of what was done."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "name string, version string, action string, comment string, metrics string, at timestamp_ntz"


class Registry:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str, version: str) -> str:
        return f"{self.folder}/models/{name}/{version}"

    def _append(self, name: str, version: str, action: str, comment: str = "", metrics: dict | None = None) -> None:
        row = (name, version, action, comment, json.dumps(metrics or {}), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.folder}/log")

    def log_model(self, model: PipelineModel, name: str, version: str, comment: str = "", metrics: dict | None = None) -> str:
        """Store a model; a version that exists is not overwritten. The first version becomes the default."""
        first = not self.versions(name)
        path = self._path(name, version)
        model.write().save(path)
        self._append(name, version, "log", comment, metrics)
        if first:
            self.set_default(name, version)
        return path

    def versions(self, name: str) -> list[str]:
        try:
            rows = self._log().filter((F.col("name") == name) & (F.col("action") == "log")).orderBy("at").collect()
        except Exception as error:  # nothing was logged yet
            if "PATH_NOT_FOUND" in str(error):
                return []
            raise
        return [r["version"] for r in rows]

    def set_default(self, name: str, version: str) -> None:
        if version not in self.versions(name):
            raise KeyError(f"{name} has no version {version}")
        self._append(name, version, "default")

    def default_version(self, name: str) -> str:
        latest = self._log().filter((F.col("name") == name) & (F.col("action") == "default")).agg(F.max_by("version", "at"))
        version = latest.first()[0]
        if version is None:
            raise KeyError(name)
        return version

    def load(self, name: str, version: str | None = None) -> PipelineModel:
        """The pinned version, or the default one."""
        return PipelineModel.load(self._path(name, version or self.default_version(name)))

    def show_models(self) -> DataFrame:
        """Versions and default of every model."""
        log = self._log()
        logged = log.filter("action = 'log'").groupBy("name").agg(
            F.sort_array(F.collect_list("version")).alias("versions"), F.max("at").alias("last_logged"))
        default = log.filter("action = 'default'").groupBy("name").agg(F.max_by("version", "at").alias("default_version"))
        return logged.join(default, "name", "left")

    def describe(self, name: str, version: str) -> dict:
        row = self._log().filter((F.col("name") == name) & (F.col("version") == version) & (F.col("action") == "log")).first()
        if row is None:
            raise KeyError(f"{name} has no version {version}")
        return {"name": name, "version": version, "comment": row["comment"], "metrics": json.loads(row["metrics"]),
                "path": self._path(name, version)}
