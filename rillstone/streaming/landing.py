"""Pick up landing files as they arrive, each reading once.

Run on a schedule with ``availableNow``: the checkpoint remembers which files
were read, the table keeps out readings it holds already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillstone.plans.air_quality import flatten_documents
from rillstone.sources.files import DOCUMENT_SCHEMA
from rillstone.session import stage
from rillstone.sources.tables import append_new_by_day


def document_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    """Readings of every file that appears in the landing folder."""
    docs = spark.readStream.schema(DOCUMENT_SCHEMA).option("multiLine", True).option(
        "maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True).json(landing)
    return flatten_documents(docs.select("records"))


def distinct_readings(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop a reading that was already seen, within the time later copies may take.

    The state of a reading is dropped after the delay, so it stays bounded.
    """
    return stream.withColumn("record_ts", F.col("record_ts").cast("timestamp")).withWatermark(
        "record_ts", delay).dropDuplicatesWithinWatermark(["record_id"])


def ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, files_per_trigger: int = 1000) -> StreamingQuery:
    """Append new readings to the daily partitions of ``table``; late ones go to their own day.

    A batch that is run again after a failure finds its readings stored and adds none. Readings
    whose time cannot be read go to ``<table>_rejected``, in a folder per batch.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch = stage(batch)  # the files are read once
        append_new_by_day(batch.filter(F.col("record_ts").isNotNull()), table, ["record_id"], "record_ts")
        batch.filter(F.col("record_ts").isNull()).write.mode("overwrite").parquet(f"{table}_rejected/batch={number}")

    return (
        document_stream(spark, landing, files_per_trigger).writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
