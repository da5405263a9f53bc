"""What a model is fitted on stays bounded, or is dealt to tasks, however many rows there are."""

import pytest
from pyspark.sql import functions as F

from rillstone.operators import models as md


def lines(spark, n):
    return spark.range(n).select(
        "id", (F.col("id") % 7).cast("int").alias("a"), (F.col("id") % 11 / 100).alias("b"), F.rand(3).alias("c"),
        ((F.col("id") % 7 >= 4) & (F.col("id") % 11 >= 6)).cast("int").alias("y"))


@pytest.mark.parametrize("name,params", [("gradient_boosting", {"maxIter": 5}), ("random_forest", {"numTrees": 20}), ("decision_tree", {})])
def test_trees_over_cells_find_the_rule(spark, name, params):
    rows = lines(spark, 4000)
    scored = md.fit_trees(rows, name, ["a", "b", "c"], "y", **params).transform(rows)
    assert scored.count() == 4000 and scored.filter("prediction = y").count() > 3900


def test_trees_are_fitted_on_bins_not_rows(spark, monkeypatch):
    fitted_on = []
    plain = md.counted
    monkeypatch.setattr(md, "counted", lambda rows: fitted_on.append(plain(rows)) or fitted_on[-1])
    rows = lines(spark, 20_000)
    for feature in ("a", "c"):  # few values, and one value a row
        md.fit_trees(rows, "decision_tree", [feature], "y")
    few, many = ([*c.collect()] for c in fitted_on)
    assert len(few) <= 14 and len(many) <= 64
    assert sum(r["_weight"] for r in few) == sum(r["_weight"] for r in many) == 20_000


def test_pieces_keep_the_weight_and_single_rows(spark):
    cells = spark.createDataFrame([("x", 5.0), ("y", 1000.0)], "k string, _weight double")
    single = md.in_pieces(cells, pieces=2000)
    assert single.count() == 1005 and {r["_weight"] for r in single.collect()} == {1.0}
    coarse = md.in_pieces(cells, pieces=100)
    assert coarse.count() <= 102
    assert {r["k"]: r["w"] for r in coarse.groupBy("k").agg(F.sum("_weight").alias("w")).collect()} == {
        "x": pytest.approx(5), "y": pytest.approx(1000)}


def test_rows_are_dealt_to_parts_of_a_size(spark):
    from rillstone.session import in_parts

    few = spark.range(0, 100_000, 1, 2)
    sizes = [r["n"] for r in in_parts(few, 5000).groupBy(F.spark_partition_id()).agg(F.count("id").alias("n")).collect()]
    assert len(sizes) == 20 and max(sizes) < 6000 and sum(sizes) == 100_000


def test_words_are_counted_without_a_shuffle_of_terms(spark):
    from rillstone.operators import textvec as tv

    docs = spark.createDataFrame([(1, "a b a"), (1, "a c"), (2, None), (None, "d d")], "k int, text string")
    bag = tv.bag_of_words(docs, "k", F.split("text", " "))
    assert bag._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # as planned, before it is run
    assert sorted(map(tuple, bag.collect()), key=str) == [(1, "a", 3), (1, "b", 1), (1, "c", 1), (None, "d", 2)]


def test_vectors_of_terms_are_made_without_python(spark):
    from rillstone.operators import termindex as ti

    rows = spark.createDataFrame([(1, "b a"), (2, None), (3, "z a")], "id int, text string")
    index = spark.createDataFrame([("a", 0, 2), ("a b", 1, 1), ("b", 2, 1), ("b a", 3, 1)], "term string, code long, docs long")
    made = ti.term_vectors(rows, ti.text_terms("text"), index, 5)
    got = {r["id"]: (r["features"].size, r["features"].indices.tolist(), r["features"].values.tolist()) for r in made.collect()}
    assert set(got) == {1, 2, 3} and all(v[0] == 5 and set(v[2]) <= {1.0} for v in got.values())
    assert not got[2][1] and got[1][1] == sorted(got[1][1])
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


def test_terms_are_numbered_and_counted_in_one_join(spark):
    from rillstone.operators import termindex as ti

    rows = spark.createDataFrame([(1, "bb aa"), (2, "aa")], "id int, text string")
    index = spark.createDataFrame([("aa", 0, 2), ("bb", 1, 1)], "term string, code long, docs long")
    got = ti.coded(rows, ti.text_terms("text"), index, "id", "docs")
    assert sorted(map(tuple, got.collect())) == [(1, 0, 2), (1, 1, 1), (2, 0, 2)]


def test_documents_are_dealt_to_parts_before_their_terms_are_counted(spark, monkeypatch):
    """One part holding all documents would count its terms in one table that outgrows memory."""
    from rillstone.operators import textvec as tv

    monkeypatch.setattr(tv, "ROWS_OF_A_PART", 50)
    part = F.concat(F.lit("part "), F.spark_partition_id().cast("string"))
    rows = spark.range(2000).coalesce(1).select(F.col("id").alias("doc_id"))
    found = {r["term"]: r["df"] for r in tv.document_frequency(
        rows, "doc_id", F.array(F.lit("all"), part, part)).collect()}
    assert found.pop("all") == 2000
    assert sum(found.values()) == 2000 and len(found) == 40 and max(found.values()) < 200
