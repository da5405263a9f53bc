"""Incremental air-quality build: a load rewrites only the days its readings can change.

A filled value depends on the last known value up to its row and, where there
is none, on the first known value after it, at station, city, state and
everywhere in turn. So a load that starts on some day changes

* rows from that day on, which need the last known values before it, and
* earlier rows of an entity whose first known value changed.

Both are read from ``edges``, one row per day and station with the first and
last known value of each measure, instead of from the history of readings.
Layers are stored by day; days before the first changed one keep their files.

A load that fails can be run again: its first day comes from all readings of
its files, stored already or not, and ``edges`` and the list of loaded files
are written last.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.joins import join_groups
from rillstone.plans import air_quality as aq
from rillstone.session import stage
from rillstone.sources import files
from rillstone.sources.tables import VersionedTable, append_new_by_day, exists, write_table

_ENTITY = ["_gid", "station", "city", "state"]


def day_edges(pivoted: DataFrame) -> DataFrame:
    """Per day and station: its last time, and the first and last known value of each measure with their times."""
    def at(m: str) -> Column:
        return F.when(F.col(m).isNotNull(), F.col("record_ts"))

    def known(m: str, side: str) -> Column:
        ts, value = F.col(f"{m}_{side}_ts"), F.col(f"{m}_{side}_value")
        return F.when(ts.isNotNull(), F.struct(ts.alias("record_ts"), value.alias("value"))).alias(f"{m}_{side}")

    # a station has one row a time, so no two values compete; times and numbers, unlike structs of them, are hashed
    days = pivoted.groupBy(F.to_date("record_ts").alias("day"), *aq.STATION_KEYS).agg(
        F.max("record_ts").alias("record_ts"),
        *[F.min(at(m)).alias(f"{m}_first_ts") for m in aq.MEASURES],
        *[F.min_by(m, at(m)).alias(f"{m}_first_value") for m in aq.MEASURES],
        *[F.max(at(m)).alias(f"{m}_last_ts") for m in aq.MEASURES],
        *[F.max_by(m, at(m)).alias(f"{m}_last_value") for m in aq.MEASURES])
    return days.select("day", *aq.STATION_KEYS, "record_ts",
                       *[known(m, "first") for m in aq.MEASURES], *[known(m, "last") for m in aq.MEASURES])


def carried(edges: DataFrame) -> DataFrame:
    """The last known value of each station and measure, as a row at its own time."""
    last = edges.groupBy(*aq.STATION_KEYS).agg(*[F.max(f"{m}_last").alias(m) for m in aq.MEASURES])
    empty = {m: F.lit(None).cast(last.schema[m].dataType["value"].dataType) for m in aq.MEASURES}
    rows = [F.struct(F.col(f"{m}.record_ts").alias("record_ts"), *[
        (F.col(f"{n}.value") if n == m else empty[n]).alias(n) for n in aq.MEASURES]) for m in aq.MEASURES]
    return last.select(*aq.STATION_KEYS, F.inline(F.array(*rows))).filter(F.col("record_ts").isNotNull())


def _first_known(edges: DataFrame) -> DataFrame:
    """Per entity of every fill level: its first day, and the first known value of each measure in fill order."""
    place = [F.col(c) for c in aq.FILL_ORDER[1:]]
    # one row a station first: only these are copied for every level
    stations = edges.groupBy(*aq.STATION_KEYS).agg(
        F.min("day").alias("day"),
        *[F.min(f"{m}_first.record_ts").alias(f"{m}_ts") for m in aq.MEASURES],
        *[F.min_by(f"{m}_first.value", f"{m}_first.record_ts").alias(f"{m}_value") for m in aq.MEASURES])
    firsts = stations.select("day", "station", "city", "state", *[
        F.when(F.col(f"{m}_ts").isNotNull(), F.struct(
            F.col(f"{m}_ts").alias("ts"), *place, F.col(f"{m}_value").alias("value"))).alias(m)
        for m in aq.MEASURES])
    return firsts.groupingSets(aq.FILL_LEVELS, "station", "city", "state").agg(
        F.grouping_id().alias("_gid"), F.min("day").alias("day"), *[F.min(m).alias(m) for m in aq.MEASURES])


def first_changed_day(before: DataFrame, after: DataFrame, start: dt.date) -> dt.date:
    """``start``, or the first day of an entity whose first known value is not what it was.

    An entity that was not there before has no earlier days.
    """
    old = _first_known(before)
    new = _first_known(after).select(*_ENTITY, *[F.col(m).alias(f"_new_{m}") for m in aq.MEASURES])
    changed = ~F.lit(True)
    for m in aq.MEASURES:
        changed = changed | ~F.col(m).eqNullSafe(F.col(f"_new_{m}"))
    day = join_groups(old, new, _ENTITY).filter(changed).agg(F.min("day")).first()[0]
    return start if day is None else min(day, start)


def _write_days(df: DataFrame, path: str, by: str) -> None:
    """Replace the days, or months, that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def load(spark: SparkSession, readings: DataFrame, warehouse: str, whole: bool = False, blocks: int | None = None) -> None:
    """Add readings, told apart by ``record_id``, and bring all layers up to date.

    The layers are then what a build from all readings gives. Readings without a
    time are stored but appear in no layer; a load without any time changes no layer.
    """
    def path(name: str) -> str:
        return f"{warehouse}/{name}"

    def since(name: str, day: dt.date) -> DataFrame:
        return spark.read.parquet(path(name)).filter(F.col("day") >= F.lit(day))

    batch = stage(readings)
    start = batch.agg(F.min(F.to_date("record_ts"))).first()[0]
    if start is None and batch.isEmpty():
        return
    append_new_by_day(batch, path("raw_readings"), ["record_id"], "record_ts")
    if start is None:
        return

    pivoted = stage(aq.pivot_readings(since("raw_readings", start), whole))
    edges = stage(day_edges(pivoted))
    first, known = start, edges
    stored = spark.read.parquet(path("edges")) if exists(spark, path("edges")) else None
    if stored is not None:
        known = stored.filter(F.col("day") < F.lit(start)).unionByName(edges)
        first = first_changed_day(stored, known, start)
        if first < start:
            pivoted = aq.pivot_readings(since("raw_readings", first), whole)
        pivoted = pivoted.unionByName(carried(stored.filter(F.col("day") < F.lit(first))))

    day = F.to_date("record_ts").alias("day")
    clean = aq.fill_gaps(pivoted, blocks).select("*", day).filter(F.col("day") >= F.lit(first))
    _write_days(clean, path("clean_readings"), "day")
    clean = since("clean_readings", first)
    _write_days(aq.time_dim(clean).select("*", day).repartition("day"), path("dim_time"), "day")
    _write_days(aq.index_fact(clean, keep=("day",)), path("fact_index"), "day")

    # a place that got another city or state moves in the marts of all its days
    places, shown = stage(aq.location_dim(known)), first
    table = VersionedTable(spark, path("dim_location"))
    if table.exists():
        old = table.read().select(F.col("location_pk"), F.struct("state", "city").alias("_was"))
        moved = places.join(old, "location_pk").filter(~F.struct("state", "city").eqNullSafe(F.col("_was")))
        earliest = join_groups(known, moved.select("latitude", "longitude"), ["latitude", "longitude"]).agg(F.min("day")).first()[0]
        shown = first if earliest is None else min(first, earliest)

    month = shown.replace(day=1)
    # both marts are sums over the same sums by city, day and pollutant
    fact, times = since("fact_index", month).drop("day"), since("dim_time", month).drop("day")
    sums = stage(aq.mart_sums(fact, times, places, aq.CITY_DAY))
    monthly = aq.monthly_of_sums(sums).withColumn("mart_month", F.make_date("year", "month", F.lit(1)))
    _write_days(monthly.repartition("mart_month"), path("monthly_by_state"), "mart_month")
    daily = aq.daily_of_sums(sums).withColumn("mart_day", F.make_date("year", "month", "day"))
    daily = daily.filter(F.col("mart_day") >= F.lit(shown))
    _write_days(daily.repartition("mart_day"), path("daily_by_city"), "mart_day")
    table.replace(places)
    _write_days(edges.repartitionByRange("day", "station"), path("edges"), "day")


def tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The layers of a warehouse folder, without the columns they are stored by."""
    by = {"clean_readings": "day", "dim_time": "day", "fact_index": "day",
          "monthly_by_state": "mart_month", "daily_by_city": "mart_day"}
    layers = {name: spark.read.parquet(f"{warehouse}/{name}").drop(column) for name, column in by.items()}
    return layers | {"dim_location": VersionedTable(spark, f"{warehouse}/dim_location").read()}


def build(spark: SparkSession, landing: str, warehouse: str, blocks: int | None = None) -> dict[str, DataFrame]:
    """Load the files of the landing folder that were not loaded yet; files are opened once."""
    manifest = f"{warehouse}/loaded_files"
    loaded = spark.read.parquet(manifest) if exists(spark, manifest) else None
    fresh = files.new_files(spark, landing, loaded)
    if fresh is not None:
        docs = files.documents_of(spark, fresh, loaded)
        if docs is not None:
            load(spark, aq.flatten_documents(docs), warehouse, blocks=blocks)
        write_table(fresh, manifest, "append")
    return tables(spark, warehouse)
