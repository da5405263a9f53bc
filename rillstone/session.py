"""Session defaults and the shared-folder staging used to cut long plans."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "rillstone", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults this library is tested under.

    Shuffle partitions, memory and file sizes are left to the cluster; pass
    them through ``conf`` with dots written as double underscores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master, where the driver
    and the executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="rillstone-stage-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back, as ``schema`` if given.

    Unlike a cache this survives lost executors, and unlike an RDD checkpoint
    the readers still prune columns and push filters. It also gives the
    optimizer the true size of an aggregate, which it would otherwise take to
    be as large as the aggregate's input: a join with a small one is then
    planned as a broadcast, and one that turned out large is not.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def in_parts(df: DataFrame, rows: int) -> DataFrame:
    """Rows dealt to parts of about ``rows``, one per core at least.

    For tables that are small in a file and grow in a task, as vectors of many
    features do: their files alone would give a task more the more rows they hold.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, math.ceil(df.count() / rows)))


def spread(df: DataFrame) -> DataFrame:
    """Give work that is heavy per row to all cores when its scan has fewer splits than that.

    A table of many files or row groups comes back unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if splits >= cores else df.repartition(cores)
