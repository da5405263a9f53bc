"""Merge targets in key buckets: results against the whole-table operators, files against what a batch touches."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from rillstone.operators import incremental as inc
from rillstone.sources.buckets import BucketedTable, HistoryTable

SHELF = "shelf string, slot int, jam string, version int"


def files(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/rows/**/*.parquet", recursive=True)}


def bucket_of(name):
    return int(name.split("_bucket=")[1].split("/")[0])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def shelf(spark, rows):
    return spark.createDataFrame(rows, SHELF)


@pytest.fixture()
def target(spark, tmp_path):
    rows = [(f"s{i % 10}", i, "plum", 5) for i in range(300)] + [(None, 1, "none", 5), ("s1", None, "fig", None)]
    return BucketedTable.create(shelf(spark, rows), str(tmp_path / "t"), ["shelf", "slot"], buckets=16, files=2)


BATCH = [("s1", 11, "quince", 6), ("s1", 11, "older", 3), ("s2", 12, "same version", 5), ("s3", 13, "stale", 4),
         ("s3", 23, "no version", None), ("new", 1, "kiwi", None), (None, 1, "found", 9), ("s1", None, "first version", 0)]


def test_upsert_equals_the_whole_table_operator(spark, target):
    before = shelf(spark, [tuple(r) for r in target.read().collect()])
    want = rows_of(inc.upsert_latest(before, shelf(spark, BATCH), target.keys, "version"), "shelf", "slot", "jam", "version")
    target.upsert(shelf(spark, BATCH), "version")
    assert rows_of(target.read(), "shelf", "slot", "jam", "version") == want
    again = BucketedTable(spark, target.path)
    assert again.keys == ["shelf", "slot"] and again.buckets == 16 and again.read().count() == len(want)


def test_other_buckets_keep_their_files(spark, target):
    before = files(target.path)
    touched = target.upsert(shelf(spark, [("s1", 11, "quince", 6)]), "version")
    after = files(target.path)
    assert len(touched) == 1
    kept = {f for f in before if bucket_of(f) not in touched}
    assert len(kept) > 10 and all(after.get(f) == before[f] for f in kept)
    assert not any(f in after for f in before if bucket_of(f) in touched)
    assert {bucket_of(f) for f in after} == {bucket_of(f) for f in before}


@pytest.mark.parametrize("batch", [[], [("s3", 13, "stale", 4), ("s4", 14, "stale", 1)]], ids=["empty", "stale"])
def test_batches_without_effect_rewrite_nothing(spark, target, batch):
    before = files(target.path)
    assert target.upsert(shelf(spark, batch), "version") == [] and files(target.path) == before


def test_new_keys_in_new_buckets(spark, tmp_path):
    table = BucketedTable.create(shelf(spark, [("a", 1, "x", 1)]), str(tmp_path / "t"), ["shelf", "slot"], buckets=64)
    table.upsert(shelf(spark, [("b", i, "y", 1) for i in range(40)]), "version")
    assert table.read().count() == 41 and len(files(table.path)) > 10
    with pytest.raises(ValueError, match="already holds"):
        BucketedTable.create(shelf(spark, []), table.path, ["shelf"])


def test_lookup_reads_the_buckets_of_its_keys(spark, target):
    found = target.lookup(shelf(spark, [("s1", 11, "", 0), (None, 1, "", 0), ("no", 1, "", 0)]))
    assert rows_of(found, "shelf", "slot", "jam") == [("s1", 11, "plum"), (None, 1, "none")]
    plan = target._some(shelf(spark, [("s1", 11, "", 0)]).withColumn("_bucket", target._bucket()))
    opened = {bucket_of(r[0]) for r in plan.select(F.input_file_name()).distinct().collect()}
    assert len(opened) == 1 and "PartitionFilters: [isnotnull(_bucket" in plan._jdf.queryExecution().toString()


BOATS = "boat int, name string, seen timestamp_ntz"
D = [dt.datetime(2030, m, 1) for m in range(1, 8)]


@pytest.fixture()
def history(spark, tmp_path):
    source = spark.createDataFrame([(i, f"b{i}", D[0]) for i in range(200)], BOATS)
    return HistoryTable.create(source, str(tmp_path / "h"), "boat", "seen", buckets=16, files=1)


def test_changes_open_and_close_versions(spark, history):
    before = files(history.table.path)
    touched = history.apply(spark.createDataFrame(
        [(3, "renamed", D[2]), (3, "between", D[1]), (4, "stale", dt.datetime(2029, 1, 1)), (900, "new", D[2])], BOATS))
    after = files(history.table.path)
    assert all(after.get(f) == before[f] for f in before if bucket_of(f) not in touched) and 1 <= len(touched) <= 2
    rows = rows_of(history.read().filter("boat in (3, 4, 900)"), "boat", "name", "valid_from", "valid_to")
    assert rows == [(3, "b3", D[0], D[2]), (3, "renamed", D[2], None), (4, "b4", D[0], None), (900, "new", D[2], None)]
    assert history.read().count() == 202


def test_snapshots_equal_the_whole_table_operator(spark, history):
    history.apply(spark.createDataFrame([(3, "renamed", D[1])], BOATS))
    old = spark.createDataFrame(history.read().collect(), history.read().schema)
    now = spark.createDataFrame([(i, "x" if i == 7 else f"b{i}" if i != 3 else "renamed", D[3] if i == 7 else D[1] if i == 3 else D[0])
                                 for i in range(200) if i != 9] + [(901, "new", D[3])], BOATS)
    columns = ["boat", "name", "seen", "valid_from", "valid_to"]
    want = rows_of(inc.scd2_merge(old, now, "boat", "seen", D[4]), *columns)
    before = files(history.table.path)
    touched = history.snapshot(now, D[4])
    assert rows_of(history.read(), *columns) == want and 1 <= len(touched) <= 3
    assert all(files(history.table.path).get(f) == before[f] for f in before if bucket_of(f) not in touched)
    assert history.snapshot(now, D[5]) == []  # the same snapshot again changes nothing


def test_a_key_that_comes_back(spark, history):
    base = [(i, f"b{i}", D[0]) for i in range(200)]
    history.snapshot(spark.createDataFrame(base[1:], BOATS), D[1])
    history.snapshot(spark.createDataFrame([(0, "back", D[2]), *base[1:]], BOATS), D[3])
    rows = rows_of(history.read().filter("boat = 0"), "name", "valid_from", "valid_to")
    assert rows == [("b0", D[0], D[1]), ("back", D[2], None)]
