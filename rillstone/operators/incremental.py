"""Incremental loads, upserts and history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.operators.joins import new_rows

__all__ = ["new_rows", "above_watermark", "in_window", "latest_per_key", "upsert_latest", "scd2_merge",
           "require_same_schema", "require_whole_days"]


def above_watermark(incoming: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows newer than everything in the target; a target without any value takes all rows.

    The watermark is a scalar subquery: one aggregate over the target, then a
    plain filter that can reach the scan.
    """
    mark = target.agg(F.max(column)).scalar()
    return incoming.filter(mark.isNull() | (F.col(column) > mark))


def in_window(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows of the half-open window from ``start`` to ``end``."""
    kind = df.schema[column].dataType
    return df.filter((F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind)))


def require_whole_days(start: dt.datetime, end: dt.datetime) -> None:
    """A window that replaces daily partitions must cover whole days."""
    if start >= end or any(t.time() != dt.time() for t in (start, end)):
        raise ValueError(f"window {start} .. {end} does not cover whole days")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key. Rows compete before the shuffle, so a hot key costs one row per task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def upsert_latest(target: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Target after an upsert: per key the row with the largest version, incoming rows winning ties."""
    both = target.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return latest_per_key(both, keys, [version, "_new"]).drop("_new")


def scd2_merge(history: DataFrame, source: DataFrame, key: str, updated_at: str, as_of) -> DataFrame:
    """Type-2 history after one more snapshot of the source.

    ``history`` holds the source columns plus ``valid_from`` and ``valid_to``.
    A newer ``updated_at`` closes the current version and opens another; a key
    missing from the source is closed at ``as_of``; a key that comes back opens
    a new version.
    """
    columns = source.columns
    as_of = F.lit(as_of).cast(history.schema["valid_to"].dataType)
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull()).select(
        F.struct(*columns).alias("old"), F.col("valid_from").alias("since"))
    latest = source.select(F.struct(*columns).alias("new"))
    pairs = current.join(latest, F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")), "full_outer")

    kind = history.schema["valid_to"].dataType
    gone, fresh = F.col("new").isNull(), F.col("old").isNull()
    changed = F.coalesce(F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}"), F.lit(False))
    opened = F.struct(F.col("new").alias("row"), F.col(f"new.{updated_at}").cast(kind).alias("valid_from"),
                      F.lit(None).cast(kind).alias("valid_to"))

    def kept(end: Column) -> Column:
        return F.struct(F.col("old").alias("row"), F.col("since").alias("valid_from"), end.cast(kind).alias("valid_to"))

    versions = (
        F.when(fresh, F.array(opened))
        .when(gone, F.array(kept(as_of)))
        .when(changed, F.array(kept(F.col(f"new.{updated_at}")), opened))
        .otherwise(F.array(kept(F.lit(None))))
    )
    merged = pairs.select(F.inline(versions)).select("row.*", "valid_from", "valid_to")
    return closed.select(*columns, "valid_from", "valid_to").unionByName(merged)


def start_history(source: DataFrame, updated_at: str) -> DataFrame:
    """First snapshot: every row is a current version."""
    kind = source.schema[updated_at].dataType
    return source.withColumns({"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast(kind)})


def require_same_schema(incoming: DataFrame, existing: DataFrame) -> None:
    """Fail when names or types differ, as an append must not change a table."""

    def shape(schema: T.StructType) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    if shape(incoming.schema) != shape(existing.schema):
        raise ValueError(f"schema changed: {shape(existing.schema)} -> {shape(incoming.schema)}")
