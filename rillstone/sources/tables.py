"""Parquet tables: appends, daily partitions, replaced windows, and versions switched by a pointer."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.incremental import in_window, new_rows, require_same_schema, require_whole_days
from rillstone.session import stage


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = _fs(spark, path)
    return fs.exists(path_of(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Overwrite a table, or append to one of the same columns and types."""
    if mode == "append" and exists(df.sparkSession, path):
        require_same_schema(df, df.sparkSession.read.parquet(path))
    df.write.mode(mode).parquet(path)


def write_clustered(df: DataFrame, path: str, ts: str, cluster: str, mode: str = "overwrite") -> None:
    """Daily partitions whose files are sorted by the clustering column, so readers skip row groups.

    Rows are ranged by day, cluster and time: neither a busy day nor a busy
    cluster ends up in one task.
    """
    order = ["day", cluster, ts]
    days = df.withColumn("day", F.to_date(ts)).repartitionByRange(*order).sortWithinPartitions(*order)
    days.write.mode(mode).partitionBy("day").parquet(path)


def replace_window(df: DataFrame, path: str, ts: str, start: dt.datetime, end: dt.datetime) -> None:
    """Replace the days from ``start`` up to ``end`` by the rows of that window; running it twice changes nothing."""
    require_whole_days(start, end)
    spark = df.sparkSession
    rows = stage(in_window(df, ts, start, end).withColumn("day", F.to_date(ts)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    # days that no longer have rows keep no old ones
    kept = {r["day"] for r in rows.select("day").distinct().collect()}
    fs, path_of = _fs(spark, path)
    day = start.date()
    while day < end.date():
        if day not in kept:
            fs.delete(path_of(f"{path}/day={day}"), True)
        day += dt.timedelta(days=1)


def append_new_by_day(df: DataFrame, path: str, keys: list[str], ts: str) -> None:
    """Append rows with new keys to the daily partition they belong to, however late they are.

    Only the days that occur in the batch are compared: one late row adds its own day, not all days since.
    """
    spark = df.sparkSession
    rows = df.withColumn("day", F.to_date(ts)).dropDuplicates(keys)
    if exists(spark, path):
        rows = stage(rows)
        days = [r["day"] for r in rows.select("day").distinct().collect()]
        same_day = F.col("day").isin([d for d in days if d is not None])
        stored = spark.read.parquet(path).filter(same_day | F.col("day").isNull() if None in days else same_day)
        rows = new_rows(rows, stored, keys)
    rows.write.mode("append").partitionBy("day").parquet(path)


class VersionedTable:
    """A table whose content is replaced as a whole, also from a query that reads it.

    Each write goes to a folder of its own; a new pointer file is renamed over the
    old one after the write is complete, so readers see the old or the new content.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def _pointer(self) -> str:
        return f"{self.path}/_current"

    def exists(self) -> bool:
        return exists(self.spark, self._pointer)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self._current()}")

    def _current(self) -> str:
        fs, path_of = _fs(self.spark, self._pointer)
        stream = fs.open(path_of(self._pointer))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, df: DataFrame) -> None:
        version = f"v-{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{version}")
        fs, path_of = _fs(self.spark, self.path)
        written = path_of(f"{self.path}/_next-{version}")
        stream = fs.create(written, True)
        try:
            stream.write(bytearray(version, "utf-8"))
        finally:
            stream.close()
        gateway, hadoop = self.spark.sparkContext._gateway, self.spark._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.valueOf("OVERWRITE")
        files = hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(written, path_of(self._pointer), options)
