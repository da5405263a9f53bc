"""Shapes of the plans that decide how the work scales."""

import re

import pytest
from pyspark.sql import functions as F

from rillstone.operators import aggregates as agg
from rillstone.operators import features as fe
from rillstone.operators import fill, incremental, neighbors
from rillstone.plans import air_quality as aq
from catalog import air
from catalog.base import table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df):
    return plan(df).split("== Initial Plan ==")[-1]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(table(spark, SF, "orders").filter("o_totalprice >= 250000").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,250000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_watermark_is_a_scalar_subquery_not_a_join(spark):
    orders = table(spark, SF, "orders")
    text = plan(incremental.above_watermark(orders, orders, "o_orderdate"))
    assert "Subquery" in text and "Join" not in text and "Cartesian" not in text


def test_fill_shuffles_rows_once_by_block(spark):
    pivoted = aq.pivot_readings(air.readings(spark, SF))
    text = plan(fill.hierarchical_fill(pivoted, aq.MEASURES, [["station"], ["city"], ["state"], []], ["record_ts", "station"], 4))
    # by block; the edge rows' own aggregation and windows shuffle one row per block and entity
    assert text.count("Exchange hashpartitioning(_block") <= 2
    assert "SinglePartition" not in text


def test_pivot_is_one_shuffle_with_partial_aggregation(spark):
    rows = spark.createDataFrame([("k", 1, 2.0)], "kind string, id int, v double")
    text = plan(agg.pivot_max(rows, ["id"], "kind", F.col("v"), {"k": "a", "l": "b"}))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_codes_join_without_shuffling_the_rows(spark):
    text = plan(fe.ordinal_encode(table(spark, SF, "part"), ["p_brand", "p_type"]))
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text


def test_best_neighbours_are_cut_before_the_shuffle(spark):
    rows = table(spark, SF, "embeddings")
    text = plan(neighbors.nearest(rows, rows, "vec_id", "embedding", "label", 3))
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("by", [[], ["p_brand"]])
def test_mode_keeps_no_map_of_values(spark, by):
    text = plan(agg.mode(table(spark, SF, "part"), by, "p_type"))
    assert "ObjectHashAggregate" not in text and "partial_min_by" in text


def test_index_is_compiled(spark):
    """The generated method has to stay under the size the JVM compiles."""
    rows = spark.range(10).select(*[F.col("id").cast("double").alias(m) for m in aq.MEASURES])
    fact = air.air_index.with_index(rows, aq.index_inputs())
    codegen = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(
        fact._jdf.queryExecution().executedPlan())
    sizes = [codegen.apply(i)._3().maxMethodCodeSize() for i in range(codegen.size())]
    assert sizes and max(sizes) < 8000


def _station_rows(spark):
    hours = "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int) % 60, 0, 0)"
    return spark.range(240).selectExpr(
        f"{hours} as record_ts", "'World' as country", "concat('S', id % 2) as state", "concat('C', id % 4) as city",
        "cast(id div 60 as string) as station", "cast(id div 60 as decimal(12,7)) as latitude",
        "cast(1 as decimal(12,7)) as longitude",
        *[f"if(id % {i + 2} = 0 and id div 60 != {i}, cast(id as double), null) as {m}" for i, m in enumerate(aq.MEASURES)])


def test_edges_and_places_are_hashed_not_sorted(spark):
    from rillstone.plans import loads

    rows = _station_rows(spark)
    edges = loads.day_edges(rows)
    assert "SortAggregate" not in plan(edges)
    places = plan(aq.location_dim(rows))
    assert places.count("HashAggregate") >= 2  # the rows of a station become one before names are sorted
    expected = {}
    for r in rows.collect():
        for m in aq.MEASURES:
            if r[m] is not None:
                key = (r["record_ts"].date(), r["station"], r["city"], m)
                first, last = expected.get(key, ((r["record_ts"], r[m]),) * 2)
                expected[key] = min(first, (r["record_ts"], r[m])), max(last, (r["record_ts"], r[m]))
    found = {(e["day"], e["station"], e["city"], m): (tuple(e[f"{m}_first"]), tuple(e[f"{m}_last"]))
             for e in edges.collect() for m in aq.MEASURES if e[f"{m}_first"] is not None}
    assert found == expected and len(found) > 20


def test_fill_sorts_once_a_level(spark):
    rows = spark.createDataFrame(
        [(1, "a", None), (2, "a", 5.0), (3, "b", None), (4, "a", None), (5, "b", 7.0), (6, "c", None)], "t int, k string, v double")
    filled = fill.hierarchical_fill(rows, ["v"], [["k"], []], ["t"], blocks=2)
    text = plan(filled)  # a backward scan would sort the rows again, latest first
    assert "_position" in text and not re.search(r"_position#\d+L? DESC", text)
    assert [r["v"] for r in filled.orderBy("t").collect()] == [5.0, 5.0, 7.0, 5.0, 7.0, 7.0]


def test_monthly_mart_from_the_sums_of_days(spark):
    rows = aq.fill_gaps(_station_rows(spark))
    parts = aq.index_fact(rows), aq.time_dim(rows), aq.location_dim(rows)
    sums = aq.mart_sums(*parts, aq.CITY_DAY)
    for got, whole in ((aq.monthly_of_sums(sums), aq.monthly_by_state(*parts)), (aq.daily_of_sums(sums), aq.daily_by_city(*parts))):
        assert got.columns == whole.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
