"""Scalar expressions on edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillstone.functions import air_index as ai
from rillstone.functions import columns as fn
from rillstone.functions import text as tx

NAMES = ["PM2.5", "PM10", "NO2", "SO2", "CO", "O3", "NH3"]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def index_frame(spark, rows):
    schema = ", ".join(f"`{n}` double" for n in NAMES)
    return spark.createDataFrame(rows, schema), {n: f"`{n}`" for n in NAMES}


def test_known_index(spark):
    df, values = index_frame(spark, [(35.0, 50.0, 20.0, 10.0, 0.5, 40.0, 10.0)])
    row = df.select(ai.air_quality_index(values).alias("i"), ai.leading_pollutant(values).alias("p")).first()
    assert (row["i"], row["p"]) == (57, "PM2.5")


def test_band_gap_is_closed_only_when_snapping(spark):
    df, values = index_frame(spark, [(30.5, *[None] * 6)])
    row = df.select(ai.air_quality_index(values).alias("snapped"), ai.air_quality_index(values, snap=False).alias("raw")).first()
    assert row["snapped"] == 51 and row["raw"] is None


def test_carbon_monoxide_snaps_to_tenths(spark):
    df, values = index_frame(spark, [(None, None, None, None, 1.04, None, None), (None, None, None, None, 1.06, None, None)])
    assert [r[0] for r in df.select(ai.air_quality_index(values)).collect()] == [50, 51]


@pytest.mark.parametrize("value,expected", [(0.0, 0), (30.0, 50), (31.0, 51), (500.0, 500), (501.0, None), (None, None)])
def test_band_edges(spark, value, expected):
    df, values = index_frame(spark, [(value, *[None] * 6)])
    assert df.select(ai.air_quality_index(values)).first()[0] == expected


def test_tie_goes_to_the_first_pollutant(spark):
    df, values = index_frame(spark, [(None, 50.0, 40.0, 40.0, None, None, None), (None,) * 7])
    assert [r[0] for r in df.select(ai.leading_pollutant(values)).collect()] == ["PM10", None]


def test_unknown_pollutant_is_refused():
    with pytest.raises(ValueError):
        ai.air_quality_index({"XYZ": "x"})


@pytest.mark.parametrize("index,label", [
    (None, "Unknown"), (0, "Good"), (50, "Good"), (50.5, "Out of Range"), (51, "Satisfactory"), (400, "Very Poor"),
    (500, "Severe"), (501, "Out of Range"), (-1, "Out of Range")])
def test_category(spark, index, label):
    assert one(spark, ai.index_category(F.lit(index).cast("double"))) == label


@pytest.mark.parametrize("text,number,whole", [
    ("30.5", 30.5, 31.0), ("NA", None, None), ("", None, None), (" 7 ", 7.0, 7.0), (None, None, None), ("-2.5", -2.5, -3.0)])
def test_parse_number(spark, text, number, whole):
    c = F.lit(text).cast("string")
    assert one(spark, fn.parse_number(c)) == number
    assert one(spark, fn.parse_number(c, whole=True)) == whole


@pytest.mark.parametrize("text,price", [
    ("$1,250.00", Decimal("1250.00")), ("$90", Decimal("90.00")), ("free", None), (None, None)])
def test_parse_price(spark, text, price):
    assert one(spark, fn.parse_price(F.lit(text).cast("string"))) == price


def test_parse_timestamp(spark):
    assert one(spark, fn.parse_timestamp(F.lit("03-07-2025 17:00:00"))) == dt.datetime(2025, 7, 3, 17)
    assert one(spark, fn.parse_timestamp(F.lit("2025-07-03"))) is None


def test_hash_key_keeps_null_positions(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("a", "a")], "x string, y string")
    assert df.select(fn.hash_key("x", "y").alias("k")).distinct().count() == 4


def test_surrogate_key_marks_nulls(spark):
    import hashlib

    df = spark.createDataFrame([(1, None)], "x int, y string")
    expected = hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert df.select(fn.surrogate_key("x", "y")).first()[0] == expected


def test_greatest_strict(spark):
    df = spark.createDataFrame([(1, 2), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(fn.greatest_strict("a", "b")).collect()] == [2, None]


def test_percent_change_rounds_half_even_and_survives_zero(spark):
    assert one(spark, fn.percent_change(F.lit(100.25), F.lit(100.0))) == 0.2
    assert one(spark, fn.percent_change(F.lit(5.0), F.lit(0.0))) is None


def test_weekend_is_saturday_and_sunday(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(5, 9)], "d date")
    assert [r[0] for r in days.select(fn.is_weekend("d")).collect()] == [False, True, True, False]


def test_uniform_does_not_depend_on_the_layout(spark):
    a = {r[0]: r[1] for r in spark.range(1000).repartition(7).select("id", fn.uniform(3, "id")).collect()}
    b = {r[0]: r[1] for r in spark.range(1000).coalesce(1).select("id", fn.uniform(3, "id")).collect()}
    assert a == b and 0 <= min(a.values()) and max(a.values()) < 1 and abs(sum(a.values()) / 1000 - 0.5) < 0.05


def test_normal_has_unit_moments(spark):
    row = spark.range(20000).select(fn.normal(1, "id").alias("z")).agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(row[0]) < 0.03 and abs(row[1] - 1) < 0.03


def test_plain_words(spark):
    assert one(spark, tx.plain_words(F.lit("Sample message! Notice: it has punctuation."))) == [
        "Sample", "message", "Notice", "punctuation"]


def test_tokens_keep_accents(spark):
    assert one(spark, tx.tokens(F.lit("Le café, a b C3 naïve_x"))) == ["le", "café", "c3", "naïve_x"]
    assert one(spark, tx.tokens(F.lit("don't it's ''x' a"), tx.WORDS_WITH_APOSTROPHE)) == ["don't", "it's", "''x"]


@pytest.mark.parametrize("words,expected", [
    (["a", "b", "c"], ["a", "b", "c", "a b", "b c"]), (["a"], ["a"]), ([], [])])
def test_bigrams(spark, words, expected):
    column = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    assert one(spark, tx.with_bigrams(column)) == expected


def test_lookup_in_a_map_of_many_keys(spark):
    mapping = {i: i * i for i in range(51)}
    assert one(spark, fn.lookup(F.lit(50), mapping)) == 2500
    assert one(spark, fn.lookup(F.lit(51), mapping)) is None
