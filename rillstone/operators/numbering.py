"""Consecutive row numbers over a whole table without a one-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.session import stage

_BITS = 33  # monotonically_increasing_id keeps the partition above this many bits


def _consecutive(numbered: DataFrame, name: str, start: int) -> DataFrame:
    """Turn (partition, index within it) ids into consecutive numbers."""
    part = F.shiftright("_mid", _BITS).cast("int")
    rows = numbered.withColumn("_part", part)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition: small, and read by every task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    index = F.col("_mid") - F.shiftleft(F.col("_part").cast("long"), _BITS)
    return rows.join(stage(offsets), "_part").withColumn(name, F.col("_offset") + index + start).drop(
        "_mid", "_part", "_offset"
    )


def number_rows(df: DataFrame, order: list[str], name: str = "row_number", start: int = 1) -> DataFrame:
    """Number the rows in the given order: sorted by range, counted per range, shifted by the counts before."""
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return _consecutive(stage(sorted_rows.withColumn("_mid", F.monotonically_increasing_id())), name, start)


def number_scan(df: DataFrame, name: str = "row_number", start: int = 1) -> DataFrame:
    """Number the rows of one scanned file in file order."""
    return _consecutive(stage(df.withColumn("_mid", F.monotonically_increasing_id())), name, start)
