"""Merge targets kept in key buckets, of which a batch rewrites only those that it changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.incremental import latest_per_key, scd2_merge, start_history, upsert_latest
from rillstone.session import stage
from rillstone.sources.tables import exists


class BucketedTable:
    """A Parquet table whose rows lie in a folder for each bucket of their key's hash.

    A merge reads the folders that the batch's keys fall into, finds those in which
    something changes, and replaces these; all other files stay as they are. A
    folder is replaced when the whole job is done. A bucket's rows are dealt over
    ``files`` tasks, so its size is no limit. Keys and numbers are stored with the table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        layout = spark.read.parquet(f"{self.path}/_layout").first()
        self.keys, self.buckets, self.files = list(layout["keys"]), layout["buckets"], layout["files"]

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: list[str], buckets: int = 256, files: int = 4) -> BucketedTable:
        """Store a table whose keys occur once; NULL is a key like any other."""
        spark, path = df.sparkSession, path.rstrip("/")
        if exists(spark, f"{path}/_layout"):
            raise ValueError(f"{path} already holds a table")
        layout = spark.createDataFrame([(keys, buckets, files)], "keys array<string>, buckets int, files int")
        layout.coalesce(1).write.parquet(f"{path}/_layout")
        table = cls(spark, path)
        table._write(df.withColumn("_bucket", table._bucket()), "append")
        return table

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    def _hash(self, by: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(by)).cast("int")

    def _bucket(self) -> Column:
        return self._hash(self.buckets)

    def _write(self, rows: DataFrame, mode: str) -> None:
        # another divisor of the same hash, so that a bucket's rows come apart
        part = F.pmod(F.shiftrightunsigned(F.xxhash64(*self.keys), 32), F.lit(self.files))
        dealt = rows.repartition("_bucket", part)
        dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.rows)

    def _all(self) -> DataFrame:
        return self.spark.read.parquet(self.rows)

    def read(self) -> DataFrame:
        return self._all().drop("_bucket")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows with these keys; only their buckets are read."""
        wanted = stage(keys.select(*self.keys).distinct().withColumn("_bucket", self._bucket()))
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"w.{k}")) for k in self.keys]
        some = self._some(wanted)
        on = same[0]
        for more in same[1:]:
            on = on & more
        return some.alias("t").join(wanted.alias("w"), on, "left_semi").drop("_bucket")

    def _some(self, batch: DataFrame) -> DataFrame:
        """The stored rows of the buckets that occur in a batch; there are at most ``buckets`` of them."""
        touched = sorted(r[0] for r in batch.select("_bucket").distinct().collect())
        return self._all().filter(F.col("_bucket").isin(touched))

    def _replace(self, changed: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Put the result of ``merged`` in place of each bucket that occurs in ``changed``; the buckets replaced."""
        touched = sorted(r[0] for r in changed.select("_bucket").distinct().collect())
        if touched:
            new = merged(self._all().filter(F.col("_bucket").isin(touched)))
            self._write(new.withColumn("_bucket", self._bucket()), "overwrite")
        return touched

    def _paired(self, batch: DataFrame, column: str) -> DataFrame:
        """A batch's rows with the stored value of one column, ``_old``, and whether there is a row, ``_held``."""
        stored = self._some(batch).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)],
                                          F.col(column).alias("_old"), F.lit(True).alias("_held"))
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        return batch.join(stored, on, "left").drop(*[f"_k{i}" for i in range(len(self.keys))])

    def upsert(self, batch: DataFrame, version: str) -> list[int]:
        """Per key the row with the largest version stays, the batch's on ties; the buckets that were replaced.

        Rows that are older than the stored ones change nothing and cost no rewrite.
        """
        rows = stage(latest_per_key(batch, self.keys, [version]).withColumn("_bucket", self._bucket()))
        paired = self._paired(rows, version)
        # as in max_by: a version beats none, and no version beats no row only
        newer = F.col("_held").isNull() | (F.col(version) >= F.col("_old")) | F.col("_old").isNull()
        winning = stage(paired.filter(newer).drop("_old", "_held"))
        fresh = winning.drop("_bucket")

        def merged(old: DataFrame) -> DataFrame:
            return upsert_latest(old.drop("_bucket"), fresh.select(*[c for c in old.columns if c != "_bucket"]), self.keys, version)

        return self._replace(winning, merged)


class HistoryTable:
    """Type-2 history in key buckets: a batch of changes, or a whole snapshot, replaces the buckets it changes.

    Which buckets those are is told by key and time of the last update alone.
    """

    def __init__(self, spark: SparkSession, path: str, updated_at: str):
        self.table, self.updated_at = BucketedTable(spark, path), updated_at
        self.key = self.table.keys[0]

    @classmethod
    def create(cls, source: DataFrame, path: str, key: str, updated_at: str, buckets: int = 256, files: int = 4) -> HistoryTable:
        """A history that starts with the first snapshot."""
        BucketedTable.create(start_history(source, updated_at), path, [key], buckets, files)
        return cls(source.sparkSession, path, updated_at)

    def read(self) -> DataFrame:
        return self.table.read()

    def _current(self, rows: DataFrame) -> DataFrame:
        return rows.filter("valid_to is null").select(
            F.col(self.key).alias("_key"), F.col(self.updated_at).alias("_was"), F.col("_bucket").alias("_at"))

    def _changed(self, batch: DataFrame, current: DataFrame, how: str) -> DataFrame:
        """Buckets in which a key is new, newer or, against a whole snapshot, gone."""
        pairs = batch.select(F.col(self.key).alias("_new"), F.col(self.updated_at).alias("_is"), "_bucket").join(
            current, F.col("_new").eqNullSafe(F.col("_key")), how)
        differs = F.col("_at").isNull() | F.col("_bucket").isNull() | (F.col("_is") > F.col("_was"))
        return stage(pairs.filter(differs).select(F.coalesce("_bucket", "_at").alias("_bucket")).distinct())

    def apply(self, changes: DataFrame) -> list[int]:
        """Changed and new rows: a newer ``updated_at`` closes a version and opens another. The buckets replaced."""
        rows = stage(latest_per_key(changes, [self.key], [self.updated_at]).withColumn("_bucket", self.table._bucket()))
        changed = self._changed(rows, self._current(self.table._some(rows)), "left")
        columns = changes.columns

        def merged(old: DataFrame) -> DataFrame:
            old = old.drop("_bucket")
            # keys that the batch does not name go by untouched
            named = F.col(f"o.{self.key}").eqNullSafe(F.col(f"n.{self.key}"))
            mine = rows.join(changed, "_bucket", "left_semi").select(*columns)
            met = old.alias("o").join(mine.alias("n"), named, "left_semi")
            rest = old.alias("o").join(mine.alias("n"), named, "left_anti")
            merged = scd2_merge(met, mine, self.key, self.updated_at, None)
            return rest.unionByName(merged.select(*old.columns))

        return self.table._replace(changed, merged)

    def snapshot(self, source: DataFrame, as_of) -> list[int]:
        """The whole source as it is now: keys that are gone are closed at ``as_of``. The buckets replaced."""
        rows = source.withColumn("_bucket", self.table._bucket())
        changed = self._changed(rows, self._current(self.table._all()), "full_outer")

        def merged(old: DataFrame) -> DataFrame:
            mine = rows.join(changed, "_bucket", "left_semi").select(*source.columns)
            return scd2_merge(old.drop("_bucket"), mine, self.key, self.updated_at, as_of).select(*[c for c in old.columns if c != "_bucket"])

        return self.table._replace(changed, merged)
