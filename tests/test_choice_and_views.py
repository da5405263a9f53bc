"""Stored transformers, the choice of a model, and views of views."""

import statistics

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from rillstone.operators import modelchoice as mc
from rillstone.operators.transformers import FrequentImputer, MedianImputer, PopulationScaler
from rillstone.plans.views import Views

# ---------------------------------------------------------------- transformers

ROWS = [(1, 4.0, "oak", 7), (2, None, None, 7), (3, float("nan"), "ash", 7), (4, 10.0, "ash", 7), (5, 1.0, "oak", None), (6, 2.0, None, 7)]


@pytest.fixture(scope="module")
def trees(spark):
    return spark.createDataFrame(ROWS, "id int, `tall.m` double, kind string, same int").repartition(3)


def test_values_are_exact_and_survive_storage(spark, trees, tmp_path):
    pipe = Pipeline(stages=[
        MedianImputer(inputCols=["tall.m", "same"], outputCols=["tall_f", "same_f"]),
        PopulationScaler(inputCols=["tall_f", "same_f"], outputCols=["tall_s", "same_s"]),
        FrequentImputer(inputCols=["kind"], outputCols=["kind_f"])])
    pipe.fit(trees).write().save(str(tmp_path / "p"))
    got = {r["id"]: r for r in PipelineModel.load(str(tmp_path / "p")).transform(trees).collect()}
    filled = [4.0, 3.0, 3.0, 10.0, 1.0, 2.0]
    assert [got[i]["tall_f"] for i in range(1, 7)] == filled
    mean, deviation = statistics.fmean(filled), statistics.pstdev(filled)
    assert [got[i]["tall_s"] for i in range(1, 7)] == pytest.approx([(v - mean) / deviation for v in filled])
    assert {got[i]["same_s"] for i in got} == {0.0} and got[5]["same_f"] == 7
    assert got[2]["kind_f"] == "ash"  # as frequent as oak, and smaller


def test_an_unfitted_pipeline_is_stored_too(spark, trees, tmp_path):
    Pipeline(stages=[MedianImputer(inputCols=["same"], outputCols=["f"])]).write().save(str(tmp_path / "p"))
    assert Pipeline.load(str(tmp_path / "p")).fit(trees).transform(trees).filter("f = 7").count() == 6


def test_columns_without_a_value_are_refused(trees):
    for kind in (MedianImputer, PopulationScaler, FrequentImputer):
        with pytest.raises(ValueError, match="no value in kind"):
            kind(inputCols=["id", "kind"], outputCols=["a", "b"]).fit(trees.withColumn("kind", F.lit(None).cast("int")))
        with pytest.raises(ValueError, match="no value in id, kind"):
            kind(inputCols=["id", "kind"], outputCols=["a", "b"]).fit(trees.withColumn("kind", F.lit(None).cast("int")).limit(0))


# ---------------------------------------------------------------- choice

@pytest.fixture(scope="module")
def points(spark):
    x, y = (F.col("id") % 20 - 10).cast("double"), (F.col("id") % 7).cast("double")
    return spark.range(1200).select("id", x.alias("x"), y.alias("y"), F.when(F.abs(x) < 5, "in").otherwise("out").alias("ring"),
                                    (x + y > 0).alias("side"), F.expr("array('a', 'b', 'c')[cast(id % 3 as int)]").alias("group"))


LINE, TREE = mc.Candidate("logistic_regression", {"regParam": 0.001}), mc.Candidate("decision_tree", {"maxDepth": 2})


@pytest.mark.parametrize("label, best", [("ring", TREE), ("side", LINE)])
def test_the_candidate_that_can_learn_it_is_chosen(points, label, best):
    choice = mc.choose(points, ["x", "y"], label, ["id"], [LINE, TREE] if best is TREE else [TREE, LINE])
    assert choice.candidate is best
    scores = choice.scores.collect()
    assert len(scores) == 6 and {r["chosen"] for r in scores if r["candidate"] == best.name} == {True}
    assert sum(r["n"] for r in scores if r["chosen"]) == 1200
    wrong = choice.predict(points).filter(F.col(label).cast("string") != F.col("predicted_class")).count()
    assert wrong <= 12 and choice.predict(points).count() == 1200


def test_equal_candidates_and_repeated_runs(points):
    same = [mc.Candidate("decision_tree", {"maxDepth": 3, "seed": s}) for s in (1, 2)]
    first, again = (mc.choose(rows, ["x", "y"], "ring", ["id"], same) for rows in (points, points.repartition(7)))
    assert first.candidate is same[0]
    assert sorted(map(tuple, first.scores.collect())) == sorted(map(tuple, again.scores.collect()))


def test_three_classes_by_one_against_the_rest(points):
    rows = points.withColumn("band", F.when(F.col("x") < -4, "low").when(F.col("x") < 4, "mid").otherwise("high"))
    boosted = [mc.Candidate("gradient_boosting", {"maxIter": 3, "maxDepth": 2})]
    choice = mc.choose(rows, ["x", "y"], "band", ["id"], boosted, folds=2)
    scored = choice.probabilities(rows)
    assert scored.filter("band <> predicted_class").count() == 0 and choice.classes == ["high", "low", "mid"]
    total = F.aggregate(F.map_values("probability"), F.lit(0.0), lambda a, b: a + b)
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    assert scored.filter(F.col("probability")[F.col("predicted_class")] < 0.5).count() == 0


def test_rows_that_cannot_be_used(points):
    holes = points.withColumn("x", F.when(F.col("id") % 5 > 0, F.col("x"))).withColumn("ring", F.when(F.col("id") % 4 > 0, F.col("ring")))
    choice = mc.choose(holes, ["x", "y"], "ring", ["id"], [TREE], folds=2)
    assert sum(r["n"] for r in choice.scores.collect()) == 720
    with pytest.raises(ValueError):
        mc.choose(points, ["x"], "ring", ["id"], [TREE], folds=1)
    with pytest.raises(ValueError, match="one fold"):
        mc.choose(points.filter("id = 1"), ["x"], "ring", ["id"], [TREE])


# ---------------------------------------------------------------- views

def test_views_are_made_after_what_they_read(spark):
    views = Views(spark, {"c": "select sum(n) as n from {b} union all select n from {a}", "b": "select n + 1 as n from {a}",
                          "a": "select id as n from {numbers}"}, prefix="vt_")
    views.add_table("numbers", spark.range(4))
    assert views.build() == ["a", "b", "c"]
    assert sorted(r[0] for r in views.read("c").collect()) == [0, 1, 2, 3, 10]
    views.add("a", "select id * 2 as n from {numbers}").build()  # the views above follow
    assert views.read("c").agg(F.max("n")).first()[0] == 16
    views.drop()
    assert not spark.catalog.tableExists("vt_c")


def test_plain_names(spark):
    assert Views(spark, {"plain_top": "select * from plain_base", "plain_base": "select 1 as one"}).build() == ["plain_base", "plain_top"]


def test_circles_and_unknown_names(spark):
    with pytest.raises(ValueError, match="p -> q -> p"):
        Views(spark, {"p": "select * from {q}", "q": "select * from {p}"}, prefix="vc_").build()
    with pytest.raises(ValueError, match="reads nowhere"):
        Views(spark, {"p": "select * from {nowhere}"}).build()
    with pytest.raises(Exception, match="cannot be found"):
        Views(spark, {"p": "select * from not_a_table_at_all"}).build()
    with pytest.raises(ValueError, match="no name"):
        Views(spark, {"a b": "select 1"})
