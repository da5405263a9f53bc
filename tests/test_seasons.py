"""Seasons, robust lines, and the same models called from SQL."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators import seasons as sn
from rillstone.operators import series as ts
from rillstone.operators import tablefunctions as tf

START = dt.date(2020, 1, 1)
SCHEMA = "pond string, day date, depth double"


def days(n, value, pond="a", every=1):
    return [(pond, START + dt.timedelta(days=i), float(value(i))) for i in range(0, n, every)]


def noisy(seed, height=1.0):
    rng = random.Random(seed)
    return lambda: rng.uniform(-height, height)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def wave(i, period):
    return math.sin((i + 7305) * 2 * math.pi / period)


@pytest.fixture(scope="module")
def ponds(spark):
    noise = noisy(1)
    rows = days(1500, lambda i: 50 + 0.02 * i + 20 * wave(i, 365.2425) + noise(), "year")
    rows += days(400, lambda i: 10 + 5 * wave(i, 7) + noise(), "week")
    rows += days(900, lambda i: 3 - 0.01 * i + noise(), "none")
    rows += days(500, lambda i: 8 * wave(i, 365.2425) + noise(), "short")  # less than two years
    rows += [("one", START, 4.0), ("blank", START, None), ("two", START, 1.0), ("two", START, 3.0), (None, START, 5.0)]
    return frame(spark, rows).cache()


def test_each_series_gets_its_seasons(ponds):
    found = {r["pond"]: r for r in sn.fit(ponds, ["pond"], "day", "depth").collect()}
    assert found["year"]["seasons"] == ["year"] and found["week"]["seasons"] == ["week"]
    assert found["none"]["seasons"] == [] and "year" not in found["short"]["seasons"]
    assert found["year"]["coefficients"][11] == pytest.approx(20, abs=0.5)
    assert found["one"]["intercept"] == 4 and found["two"]["intercept"] == pytest.approx(2)
    assert found["blank"]["intercept"] is None and found[None]["intercept"] == 5


def test_coefficients_are_least_squares(ponds):
    rows = sorted((r["day"], r["depth"]) for r in ponds.filter("pond = 'week'").collect())
    x = sn.feature_matrix(np.array([(d - dt.date(1970, 1, 1)).days for d, _ in rows], float), (sn.WEEK,))
    want, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), np.array([v for _, v in rows]), rcond=None)
    got = sn.fit(ponds.filter("pond = 'week'"), ["pond"], "day", "depth", (sn.WEEK,)).first()
    assert [got["intercept"], *got["coefficients"]] == pytest.approx(want.tolist(), rel=1e-6, abs=1e-6)


def test_intervals_widen(ponds):
    ahead = sn.forecast(sn.fit(ponds.filter("pond = 'none'"), ["pond"], "day", "depth"), ["pond"], 2000)
    width = [r[0] for r in ahead.orderBy("ts").select(F.col("upper_bound") - F.col("lower_bound")).collect()]
    assert width == sorted(width) and width[-1] > 1.01 * width[0]


def test_several_values_a_day_count_one_by_one(spark):
    noise = noisy(4)
    once = days(60, lambda i: 2 + 0.5 * i + noise()) + days(60, lambda i: 2 + 0.5 * i + noise())
    got = sn.fit(frame(spark, once), ["pond"], "day", "depth", ()).first()
    want = ts.fit_trend(frame(spark, once), ["pond"], "day", "depth").first()
    assert got["n"] == want["n"] == 120 and got["sigma"] == pytest.approx(want["sigma"])
    assert got["coefficients"][0] / sn.YEAR.days == pytest.approx(want["slope"])


def test_no_keys_and_no_rows(spark, ponds):
    assert sn.forecast(sn.fit(ponds.filter("pond = 'none'").drop("pond"), [], "day", "depth"), [], 5).count() == 5
    assert sn.fit(frame(spark, []), ["pond"], "day", "depth").count() == 0


# ---------------------------------------------------------------- table functions

def sql(spark, df, text):
    tf.register(spark)
    df.createOrReplaceTempView("depths")
    return spark.sql(text)


def rounded(df, *columns):
    return sorted((tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("names", ["", "week,month,year"])
def test_forecast_function_equals_the_operator(spark, ponds, names):
    got = sql(spark, ponds, f"""SELECT * FROM forecast(input_data => TABLE(depths) PARTITION BY pond, series_colname => 'pond',
        timestamp_colname => 'day', target_colname => 'depth', forecasting_periods => 20, prediction_interval => 0.9, seasons => '{names}')""")
    some = tuple(sn.KNOWN[n] for n in names.split(",") if n)
    want = sn.forecast(sn.fit(ponds, ["pond"], "day", "depth", some), ["pond"], 20, some, level=0.9)
    columns = ["pond", "ts", "forecast", "lower_bound", "upper_bound"]
    assert rounded(got, *columns) == rounded(want, *columns)


def test_anomaly_function_equals_the_operator(spark, ponds):
    cut = dt.date(2021, 1, 1)
    spiky = ponds.withColumn("depth", F.when(F.dayofyear("day") % 50 == 7, F.col("depth") + 30).otherwise(F.col("depth")))
    got = sql(spark, spiky, f"""SELECT * FROM detect_anomalies(input_data => TABLE(depths) PARTITION BY pond ORDER BY day,
        series_colname => 'pond', timestamp_colname => 'day', target_colname => 'depth', since => '{cut}')""")
    want = sn.detect_anomalies(spiky, ["pond"], "day", "depth", cut, ()).withColumnRenamed("day", "ts")
    columns = ["pond", "ts", "forecast", "lower_bound", "is_anomaly"]
    assert rounded(got, *columns) == rounded(want, *columns) and got.filter("is_anomaly").count() > 10


def test_one_series_needs_no_key(spark, ponds):
    got = sql(spark, ponds.filter("pond = 'none'"), """SELECT * FROM forecast(input_data => TABLE(depths) WITH SINGLE PARTITION,
        timestamp_colname => 'day', target_colname => 'depth', forecasting_periods => 3)""")
    assert got.columns == ["ts", "forecast", "lower_bound", "upper_bound"] and got.count() == 3


@pytest.mark.parametrize("arguments, message", [
    ("timestamp_colname => 'when', target_colname => 'depth'", "no column when"),
    ("timestamp_colname => 'day', target_colname => 'depth', seasons => 'century'", "not century")])
def test_wrong_arguments(spark, ponds, arguments, message):
    with pytest.raises(Exception, match=message):
        sql(spark, ponds, f"SELECT * FROM forecast(input_data => TABLE(depths) PARTITION BY pond, {arguments})")


def test_rows_out_of_order_are_refused(spark, ponds):
    with pytest.raises(Exception, match="ORDER BY"):
        sql(spark, ponds.orderBy(F.desc("day")).coalesce(1), """SELECT * FROM detect_anomalies(
            input_data => TABLE(depths) PARTITION BY pond ORDER BY day DESC, timestamp_colname => 'day',
            target_colname => 'depth', since => '2021-01-01')""").collect()


# ---------------------------------------------------------------- robust lines

def test_outliers_do_not_move_the_robust_line(spark):
    noise = noisy(9)
    rows = days(400, lambda i: 5 + 0.1 * i + noise() + (200 if i % 9 == 0 else 0))
    plain = ts.fit_trend(frame(spark, rows), ["pond"], "day", "depth").first()
    robust = ts.fit_trend_robust(frame(spark, rows), ["pond"], "day", "depth").first()
    clean = ts.fit_trend(frame(spark, [r for i, r in enumerate(rows) if i % 9]), ["pond"], "day", "depth").first()
    assert robust["slope"] == pytest.approx(clean["slope"]) and robust["sigma"] == pytest.approx(clean["sigma"])
    assert robust["n"] == clean["n"] and plain["sigma"] > 20 * robust["sigma"]


def test_robust_line_of_exact_short_and_empty_series(spark):
    rows = days(50, lambda i: 2 * i, "line") + [("one", START, 7.0), ("none", START, None), ("two", START, 1.0), ("two", START, 1.0)]
    found = {r["pond"]: r for r in ts.fit_trend_robust(frame(spark, rows), ["pond"], "day", "depth").collect()}
    assert found["line"]["slope"] == pytest.approx(2) and found["line"]["sigma"] == pytest.approx(0, abs=1e-4)
    assert found["one"]["slope"] == 0 and found["one"]["intercept"] == pytest.approx(7) and found["two"]["n"] == 2
    assert "none" not in found
    assert ts.fit_trend_robust(frame(spark, []), ["pond"], "day", "depth").count() == 0


def test_earlier_anomalies_do_not_hide_later_ones(spark):
    noise = noisy(12)
    rows = days(300, lambda i: 20 + noise() + (90 if i % 12 == 5 else 0))
    cut = START + dt.timedelta(days=200)
    flags = lambda robust: {r["day"] for r in ts.detect_anomalies(
        frame(spark, rows), ["pond"], "day", "depth", cut, level=0.999, robust=robust).filter("is_anomaly").collect()}
    planted = {r[1] for i, r in enumerate(rows) if i % 12 == 5 and r[1] >= cut}
    assert flags(True) == planted and flags(False) != planted
