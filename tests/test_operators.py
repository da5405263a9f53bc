"""Operators against brute force on small tables, with skew, ties, NULLs and several blocks."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillstone.operators import aggregates as agg
from rillstone.operators import evaluate as ev
from rillstone.operators import features as fe
from rillstone.operators import fill, incremental, joins, neighbors, numbering, quality, select, series
from rillstone.operators import textvec as tv
from rillstone.operators.quantiles import exact_quantiles


# ---------------------------------------------------------------- filling

def gappy_frame(n=400, seed=1):
    """A third of the rows at one station, equal timestamps, and a station without any value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        station = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "empty"])
        city = {"hot": "x", "a": "x", "b": "y", "c": "y", "empty": "z"}[station]
        value = None if station == "empty" or rng.random() < 0.6 else float(i)
        other = float(-i) if rng.random() < 0.05 else None
        rows.append((i, rng.randrange(40), station, city, "s" if city != "z" else "t", value, other))
    return pd.DataFrame(rows, columns=["id", "ts", "station", "city", "state", "v", "w"])


def brute_fill(pdf, levels, measures):
    pdf = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    out = pdf.copy()
    for m in measures:
        found = pdf[m]
        for level in levels:
            groups = pdf.groupby(level)[m] if level else pdf[m]
            found = found.fillna(groups.ffill()).fillna(groups.bfill())
        out[m] = found
    return out


@pytest.mark.parametrize("blocks", [1, 5, 16])
def test_hierarchical_fill_over_blocks(spark, blocks):
    pdf, levels = gappy_frame(), [["station"], ["city"], ["state"], []]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, ts long, station string, city string, state string, v double, w double")
    got = fill.hierarchical_fill(df, ["v", "w"], levels, ["ts", "id"], blocks).toPandas().sort_values("id")
    want = brute_fill(pdf, levels, ["v", "w"]).sort_values("id")
    for m in ("v", "w"):
        np.testing.assert_array_equal(got[m].to_numpy(), want[m].to_numpy())


def test_forward_and_backward_fill_over_blocks(spark):
    pdf = gappy_frame(200, seed=2)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, ts long, station string, city string, state string, v double, w double")
    ordered = pdf.sort_values(["ts", "id"])
    for operator, method in ((fill.forward_fill, "ffill"), (fill.backward_fill, "bfill")):
        got = operator(df, ["v"], ["station"], ["ts", "id"], 7).toPandas().set_index("id")["v"].sort_index()
        want = getattr(ordered.groupby("station")["v"], method)()
        want.index = ordered["id"]
        np.testing.assert_array_equal(got.to_numpy(), want.sort_index().to_numpy())


def test_fill_runs_its_windows_inside_blocks(spark):
    df = spark.createDataFrame(gappy_frame(50).drop(columns=["w"]).dropna(), "id long, ts long, station string, city string, state string, v double")
    plan = fill.hierarchical_fill(df, ["v"], [["station"], []], ["ts", "id"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


# ---------------------------------------------------------------- quantiles, modes, summaries

@pytest.mark.parametrize("by", [None, ["g"]])
def test_bracketed_quantiles_equal_the_builtin(spark, by):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.lognormal(size=3000), np.full(2000, 1.0), rng.normal(size=1000)])
    groups = np.where(np.arange(6000) % 3 == 0, "hot", (np.arange(6000) % 7).astype(str))
    df = spark.createDataFrame(pd.DataFrame({"g": groups, "v": values}))
    probs = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p99": 0.99, "hi": 1.0}
    large = exact_quantiles(df, "v", probs, by).toPandas()
    small = df.groupBy(*(by or [])).agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()]).toPandas()
    if by:
        large, small = large.sort_values("g"), small.sort_values("g")
    np.testing.assert_allclose(large[list(probs)].to_numpy(float), small[list(probs)].to_numpy(float), rtol=1e-12)


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), ("b", None), ("b", 5)], "g string, v int")
    assert dict(agg.mode(df, ["g"], "v").collect()) == {"a": 1, "b": 5}


def test_cross_tab_leaves_missing_cells_null(spark):
    df = spark.createDataFrame([("mon", 1), ("mon", 1), ("tue", 2)], "d string, h int")
    rows = {r["d"]: (r["h1"], r["h2"]) for r in agg.cross_tab(df, "d", "h", [1, 2], "h").collect()}
    assert rows == {"mon": (2, None), "tue": (None, 1)}


def test_histogram_of_a_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    assert [(r["bin"], r["count"]) for r in agg.histogram(df, "v", 10).collect()] == [(0, 5)]


def test_pivot_compares_numbers_not_text(spark):
    from rillstone.functions.columns import parse_number

    df = spark.createDataFrame([("k", "9"), ("k", "10"), ("k", "NA")], "kind string, v string")
    row = agg.pivot_max(df, [F.lit(1).alias("one")], "kind", parse_number("v"), {"k": "k"}).first()
    assert row["k"] == 10.0


def test_change_with_zero_base(spark):
    df = spark.createDataFrame([("s", 1, 0.0), ("s", 2, 5.0), ("s", 4, 10.0)], "e string, m int, v double")
    rows = agg.change_from_previous(df, "e", ["m"], "v").orderBy("m").collect()
    assert [r["v_pct_change"] for r in rows] == [None, None, 100.0]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = {r["column"]: (r["type"], r["non_null"], r["null_ratio"]) for r in agg.null_profile(df).collect()}
    assert rows == {"a": ("int", 2, 0.0), "b": ("string", 1, 0.5)}


# ---------------------------------------------------------------- numbering, joins, splits

def test_row_numbers_over_several_partitions(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "v int")
    rows = numbering.number_rows(df.repartition(6), ["v"]).collect()
    assert sorted((r["v"], r["row_number"]) for r in rows) == [(v, v + 1) for v in range(101)]


def test_anti_join_survives_a_null_key_in_the_target(spark):
    incoming = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(1,), (None,)], "k int")
    assert {r["k"] for r in joins.new_rows(incoming, target, ["k"]).collect()} == {2, None}


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    left = spark.createDataFrame([(0 if i % 3 == 0 else i, i) for i in range(300)], "k int, x int")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 300, 2)], "k int, y string")
    plain = sorted(map(tuple, left.join(right, "k", how).collect()))
    assert sorted(map(tuple, joins.salted_join(left, right, "k", how, salts=4, share=0.1).collect())) == plain


def test_calendar_flag_is_the_day_after(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 10),), (dt.date(2024, 1, 10),)], "d date")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 11, 23)), (2, dt.datetime(2024, 1, 10)), (3, None)], "i int, ts timestamp_ntz")
    flagged = joins.flag_day_after(rows, "ts", days, "d", "hit", "miss", "f")
    assert sorted((r["i"], r["f"]) for r in flagged.collect()) == [(1, "hit"), (2, "miss"), (3, "miss")]


def test_split_is_disjoint_and_independent_of_layout(spark):
    df = spark.range(2000)
    parts = select.split(df, {"a": 0.9, "b": 0.1}, ["id"], seed=4)
    again = select.split(df.repartition(13), {"a": 0.9, "b": 0.1}, ["id"], seed=4)
    a, b = ({r[0] for r in parts[g].collect()} for g in "ab")
    assert not a & b and len(a | b) == 2000 and 120 < len(b) < 280
    assert {r[0] for r in again["b"].collect()} == b


def test_delete_keeps_rows_with_an_unknown_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r["v"] for r in select.delete_where(df, F.col("v") > 2).collect()] == [1, None]


def test_column_kinds(spark):
    df = spark.createDataFrame([], "a int, b double, c string, d decimal(5,2), y double, t date")
    assert select.numeric_and_text_columns(df, "y") == (["a", "b", "d"], ["c"])


# ---------------------------------------------------------------- incremental

def test_two_batches_insert_only_new_keys(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "corrected"), (3, "c")], "k int, v string")
    table = first.unionByName(incremental.new_rows(second, first, ["k"]))
    assert sorted(map(tuple, table.collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_watermark_on_an_empty_target_loads_everything(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),)], "ts timestamp_ntz")
    assert incremental.above_watermark(rows, rows.limit(0), "ts").count() == 2
    assert incremental.above_watermark(rows, rows.limit(1), "ts").count() == 1


def test_upsert_ignores_older_versions(spark):
    target = spark.createDataFrame([(1, 5, "old"), (2, 9, "kept")], "k int, ver int, v string")
    incoming = spark.createDataFrame([(1, 5, "new"), (2, 8, "late"), (3, 1, "added")], "k int, ver int, v string")
    rows = incremental.upsert_latest(target, incoming, ["k"], "ver").collect()
    assert sorted((r["k"], r["v"]) for r in rows) == [(1, "new"), (2, "kept"), (3, "added")]


def test_history_through_update_delete_and_return(spark):
    schema = "id int, name string, updated_at timestamp_ntz"
    day = lambda d: dt.datetime(2024, 1, d)
    history = incremental.start_history(spark.createDataFrame([(1, "a", day(1)), (2, "b", day(1))], schema), "updated_at")

    def snapshot(rows, at):
        nonlocal history
        history = incremental.scd2_merge(history, spark.createDataFrame(rows, schema), "id", "updated_at", day(at))

    snapshot([(1, "a2", day(3))], 4)                     # 1 changed, 2 gone
    snapshot([(1, "a2", day(3))], 5)                     # nothing new
    snapshot([(1, "a2", day(3)), (2, "b", day(6))], 7)   # 2 is back
    rows = sorted((r["id"], r["name"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in history.collect())
    assert rows == [(1, "a", 1, 3), (1, "a2", 3, None), (2, "b", 1, 4), (2, "b", 6, None)]


def test_schema_change_fails(spark):
    a, b = spark.createDataFrame([], "x int"), spark.createDataFrame([], "x long")
    with pytest.raises(ValueError):
        incremental.require_same_schema(a, b)


# ---------------------------------------------------------------- quality

def test_quality_report(spark):
    df = spark.createDataFrame([(1, "t", 0), (2, "x", 3), (2, None, None)], "id int, flag string, nights int")
    checks = [quality.not_null("flag"), quality.accepted_values("flag", ["t", "f"]), quality.positive_value("nights"),
              quality.no_nulls(df), quality.distinct_count_equals("id", 2), quality.max_at_most("nights", 2, "warn"),
              quality.matches("flag", "^[tf]$")]
    rows = [(r["check"], r["failures"], r["status"]) for r in quality.report(df, checks).collect()]
    assert rows == [("not_null", 1, "fail"), ("accepted_values", 1, "fail"), ("positive_value", 1, "fail"), ("no_nulls", 1, "fail"),
                    ("distinct_count", 0, "pass"), ("max_at_most", 1, "warn"), ("matches_regex", 1, "fail")]
    assert quality.unique(df, ["id"]).first()["failures"] == 1


def test_freshness_bands(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "ts timestamp_ntz")
    status = lambda h: quality.freshness(df, "ts", dt.datetime(2024, 1, 1, 12) + dt.timedelta(hours=h)).first()["status"]
    assert [status(1), status(24), status(25)] == ["pass", "warn", "error"]
    assert quality.freshness(df.limit(0), "ts", dt.datetime(2024, 1, 1)).first()["status"] == "error"


def test_column_types(spark):
    df = spark.createDataFrame([], "p decimal(10,2), s string")
    assert quality.column_type_is(df, "p", "number") and quality.column_type_is(df, "p", "decimal(10,2)")
    assert not quality.column_type_is(df, "s", "number")


def test_listing_with_hosts_takes_the_cleansed_nights(spark):
    from rillstone.plans import listings

    raw = spark.createDataFrame([(1, "u", "n", "Private room", 0, 7, "$10", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))],
                                "id int, listing_url string, name string, room_type string, minimum_nights int, host_id int, price string, created_at timestamp_ntz, updated_at timestamp_ntz")
    hosts = spark.createDataFrame([(7, None, "t", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5))],
                                  "id int, name string, is_superhost string, created_at timestamp_ntz, updated_at timestamp_ntz")
    row = listings.listings_with_hosts(listings.clean_listings(raw), listings.clean_hosts(hosts)).first()
    assert (row["minimum_nights"], row["host_name"], row["updated_at"]) == (1, "Anonymous", dt.datetime(2024, 1, 5))


# ---------------------------------------------------------------- features and text

def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    out = fe.min_max_scale(fe.standard_scale(df, ["v"]), ["v"]).select("v_z", "v_norm").collect()
    assert [tuple(r) for r in out] == [(0.0, 0.0), (0.0, 0.0), (None, None)]


def test_scaling_by_statistics_of_another_table(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    out = fe.min_max_scale(spark.createDataFrame([(5.0,)], "v double"), ["v"], fitted_on=train).first()
    assert out["v_norm"] == 0.5


def test_unknown_category_gets_zeros(spark):
    df = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    rows = fe.one_hot(df, "c", ["a", "b"]).collect()
    assert [(r["c_a"], r["c_b"]) for r in rows] == [(1, 0), (0, 0), (0, 0)]


def test_codes_follow_the_sorted_values(spark):
    df = spark.createDataFrame([(f"v{i % 37:02d}",) for i in range(200)], "c string")
    assert dict(fe.categories(df, "c").select("c", "_code").collect()) == {f"v{i:02d}": i for i in range(37)}


def test_one_hot_vector_of_any_cardinality(spark):
    df = spark.createDataFrame([(f"v{i:04d}",) for i in range(1500)] + [(None,)], "c string")
    out = {r["c"]: r["v"] for r in fe.one_hot_vector(df, "c", "v").collect()}
    assert out["v0003"].size == 1500 and out["v0003"].indices.tolist() == [3] and out[None].numNonzeros() == 0
    less = {r["c"]: r["v"] for r in fe.one_hot_vector(df, "c", "v", drop_first=True).collect()}
    assert less["v0000"].numNonzeros() == 0 and less["v0003"].indices.tolist() == [2] and less["v0003"].size == 1499


# ---------------------------------------------------------------- NULL is a group

@pytest.fixture(scope="module")
def with_null_group(spark):
    rows = [("a", float(i), i) for i in range(6)] + [(None, float(10 * i), i) for i in range(5)] + [("a", None, 9), (None, None, 9)]
    return spark.createDataFrame(rows, "g string, v double, d int")


def test_null_group_keeps_its_statistics(with_null_group):
    assert {r["g"]: r["m"] for r in exact_quantiles(with_null_group, "v", {"m": 0.5}, ["g"]).collect()} == {"a": 2.5, None: 20.0}
    assert {r["g"]: r["median"] for r in agg.box_summary(with_null_group, "v", "g").collect()} == {"a": 2.5, None: 20.0}
    filled = fe.impute_median(with_null_group, ["v"], ["g"]).filter("d = 9").collect()
    assert {r["g"]: r["v"] for r in filled} == {"a": 2.5, None: 20.0}
    shares = agg.share_of_stack(with_null_group.filter("v is not null"), ["g"], "v")
    assert shares.filter("g is null and share is null").count() == 0
    board = agg.leaderboard(with_null_group, "g", "v", "d")
    assert board.filter("d is null").count() == 0


def test_null_series_has_a_trend(with_null_group):
    rows = with_null_group.filter("v is not null").withColumn("ts", F.expr("timestamp'2024-01-01' + make_dt_interval(d)"))
    model = {r["g"]: r["slope"] for r in series.fit_trend(rows, ["g"], "ts", "v").collect()}
    assert model == pytest.approx({"a": 1.0, None: 10.0})


def test_watermark_without_a_value_keeps_old_and_null_times(spark):
    rows = spark.createDataFrame([(dt.datetime(1950, 1, 1),), (None,), (dt.datetime(2020, 1, 1),)], "ts timestamp")
    assert incremental.above_watermark(rows, rows.limit(0), "ts").count() == 3


def test_repeated_combination_with_a_null_is_no_key(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert quality.unique(rows, ["x", "y"]).first()["failures"] == 1
    assert quality.unique(rows, ["y"]).first()["failures"] == 0


def test_numbers_are_spelled_as_numbers(spark):
    from rillstone.functions.columns import parse_number

    rows = spark.createDataFrame([(t,) for t in ["1.5", " -2 ", "3e2", ".5", "NaN", "Infinity", "12d", "", "NA"]], "t string")
    got = [r[0] for r in rows.select(parse_number("t")).collect()]
    assert got == [1.5, -2.0, 300.0, 0.5, None, None, None, None, None]


def test_equal_rows_of_a_hot_key_part(spark):
    left = spark.createDataFrame([("h", 1)] * 400 + [(None, 2)] * 50 + [("x", 3)], "k string, v int")
    right = spark.createDataFrame([("h", "H"), ("x", "X")], "k string, name string")
    got = joins.salted_join(left, right, "k", "left", salts=8, share=0.1)
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", "left").collect()))


def test_naive_bayes_against_numpy(spark):
    rows = [(0, "x", {"a": 3, "b": 1}), (1, "y", {"b": 2, "c": 2}), (2, "x", {"a": 1}), (3, "y", {"c": 5})]
    labels = spark.createDataFrame([(i, c) for i, c, _ in rows], "id int, cls string")
    bag = spark.createDataFrame([(i, t, n) for i, _, d in rows for t, n in d.items()], "id int, term string, n int")
    model = tv.NaiveBayes.fit(bag, labels, "id", "cls")
    test = spark.createDataFrame([(10, "a", 1), (11, "c", 1), (12, "unseen", 4)], "id int, term string, n int")
    docs = spark.createDataFrame([(10,), (11,), (12,), (13,)], "id int")
    assert dict(model.predict(docs, test, "id").collect()) == {10: "x", 11: "y", 12: "x", 13: "x"}


# ---------------------------------------------------------------- evaluation

def test_report_with_an_empty_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "y string, p string")
    rows = {r["class"]: r for r in ev.class_report(df, "y", "p").collect()}
    assert rows["b"]["recall"] == 0 and rows["c"]["precision"] == 0 and rows["a"]["precision"] == 0.5
    assert rows["accuracy"]["precision"] == pytest.approx(1 / 3) and rows["macro avg"]["support"] == 3
    assert ev.confusion(df, "y", "p").count() == 9


def test_mape_leaves_out_zero_labels(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, p double")
    row = ev.regression_metrics(df, "y", "p").first()
    assert row["mape"] == pytest.approx(0.1) and row["zero_labels"] == 1 and row["mae"] == 1.0


# ---------------------------------------------------------------- neighbours

@pytest.mark.parametrize("chunk_rows,block_rows,pivots", [(10_000, 10_000, 8), (17, 13, 5), (50, 1000, 1)])
def test_neighbours_equal_brute_force(spark, chunk_rows, block_rows, pivots):
    rng = np.random.default_rng(3)
    # one tight cluster holds most rows, some of them identical
    train = np.concatenate([rng.normal(scale=0.01, size=(120, 4)).round(2), rng.normal(scale=5, size=(60, 4))])
    test = np.concatenate([rng.normal(scale=0.01, size=(20, 4)), rng.normal(scale=5, size=(20, 4))])
    frame = lambda m, start: spark.createDataFrame([(start + i, v.tolist(), i % 3) for i, v in enumerate(m)], "id long, v array<double>, y int")
    got = neighbors.nearest(frame(train, 0), frame(test, 1000), "id", "v", "y", 7, pivots, chunk_rows, block_rows).collect()
    d = np.sqrt(((test[:, None] - train[None]) ** 2).sum(2))
    want = {(1000 + q, r + 1): t for q in range(len(test)) for r, t in enumerate(np.lexsort((np.arange(len(train)), d[q]))[:7])}
    assert {(r["id"], r["rank"]): r["neighbour"] for r in got} == want


def test_fewer_training_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0], 1), (2, [1.0], 2)], "id long, v array<double>, y int")
    assert neighbors.nearest(df, df, "id", "v", "y", 5).count() == 4


# ---------------------------------------------------------------- series

def sales(spark):
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i), 2.0 + i, 50 + i % 5) for s in ("jacket", "umbrella") for i in range(12)]
    return spark.createDataFrame(rows, "item string, day date, sales double, temperature int")


def test_linear_series_goes_on(spark):
    model = series.fit_trend(sales(spark), ["item"], "day", "sales")
    rows = series.forecast(model, ["item"], 3).orderBy("item", "ts").collect()
    assert [round(r["forecast"], 6) for r in rows] == [14, 15, 16] * 2
    assert all(abs(r["upper_bound"] - r["forecast"]) < 1e-4 for r in rows)


def test_forecast_with_features(spark):
    features = {"t": series.day_number("day"), "temperature": F.col("temperature")}
    model = series.fit_linear(sales(spark), ["item"], features, "sales")
    future = spark.createDataFrame([("jacket", dt.date(2020, 1, 13), 52), ("jacket", dt.date(2020, 1, 14), 53)], "item string, day date, temperature int")
    assert [round(r["forecast"], 5) for r in series.predict_linear(model, future, ["item"], features).orderBy("day").collect()] == [14, 15]


def test_constant_feature_does_not_break_the_fit(spark):
    features = {"t": series.day_number("day"), "one": F.lit(3.0)}
    row = series.fit_linear(sales(spark), [], features, "sales").first()
    assert row["coefficients"][0] == pytest.approx(1.0) and row["coefficients"][1] == pytest.approx(0.0, abs=1e-9)


def test_single_point_series_carries_its_level(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 5.0)], "k string, day date, v double")
    assert series.forecast(series.fit_trend(df, ["k"], "day", "v"), ["k"], 1).first()["forecast"] == 5.0


def test_monthly_anomaly_is_flagged(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), 10.0 + (i % 2) + (50 if i == 45 else 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    flags = series.detect_anomalies(df, ["k"], "day", "v", dt.date(2024, 2, 5))
    assert [r["day"] for r in flags.filter("is_anomaly").collect()] == [dt.date(2024, 2, 15)]


def test_weekly_season(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + (20 if i % 7 == 5 else 0)) for i in range(70)]
    model = series.fit_trend(spark.createDataFrame(rows, "k string, day date, v double"), ["k"], "day", "v", weekly=True)
    ahead = series.forecast(model, ["k"], 7).orderBy("ts").collect()
    assert [r["forecast"] > 110 for r in ahead] == [False] * 5 + [True, False]
