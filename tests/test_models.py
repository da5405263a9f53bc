"""Quality floors, storage and scoring of models, with fixed seeds and key-based splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators import evaluate as ev
from rillstone.operators import generate as gen
from rillstone.operators import models as md
from rillstone.operators import termindex as ti
from rillstone.operators.registry import Registry
from rillstone.operators.select import split

X = [f"x{i}" for i in range(1, 7)]


@pytest.fixture(scope="module")
def classes(spark):
    rows = gen.classification_table(spark.range(1500), "id", seed=1).cache()
    return split(rows, {"train": 0.7, "test": 0.3}, ["id"], seed=2)


def accuracy(df, label="y"):
    return ev.accuracy(df, label, "prediction").first()["accuracy"]


@pytest.mark.parametrize("name,params", [
    ("logistic_regression", {}), ("decision_tree", {}), ("random_forest", {"numTrees": 20}),
    ("gradient_boosting", {"maxIter": 8}), ("linear_svm", {"maxIter": 20})])
def test_classifiers_beat_the_floor(classes, name, params):
    model = md.fit(classes["train"], name, X, "y", **params)
    assert accuracy(md.predict(model, classes["test"])) > 0.85


def test_importance_finds_the_informative_features(spark, classes):
    model = md.fit(classes["train"], "random_forest", X, "y", numTrees=20)
    rows = md.feature_importance(spark, model, X).collect()
    assert {r["feature"] for r in rows[:2]} == {"x1", "x2"} and sum(r["importance"] for r in rows) == pytest.approx(1)


def test_linear_regression_recovers_the_weights(spark):
    rows = gen.regression_table(spark.range(2000), "id", [26.0, 38.6, 0.2, 61.3], noise=0.1)
    features = ["x1", "x2", "x3", "x4"]
    found = dict(md.coefficients(spark, md.fit(rows, "linear_regression", features, "y"), features).collect())
    assert [round(found[f], 1) for f in features] == [26.0, 38.6, 0.2, 61.3]


def test_clusters_agree_with_the_classes(spark):
    rows = gen.classification_table(spark.range(600), "id", gap=3.0, seed=3)
    scored = md.predict(md.fit(rows, "k_means", X), rows)
    cells = ev.cluster_agreement(scored, "prediction", "y").collect()
    assert sum(r["count"] for r in cells if r["label"] == r["prediction"]) > 590


def test_fourier_features_separate_rings(spark):
    rng = np.random.default_rng(0)
    angle, radius = rng.uniform(0, 6.28, 400), np.where(np.arange(400) % 2, 1.0, 3.0)
    points = np.c_[radius * np.cos(angle), radius * np.sin(angle)]
    df = spark.createDataFrame([(i, p.tolist(), int(i % 2)) for i, p in enumerate(points)], "id int, v array<double>, y int")
    mapped = md.random_fourier_features(df, "v", 2, size=64, gamma=0.5)
    model = md.fit_vectors(mapped, "linear_svm", "y", maxIter=50, regParam=0.001)
    assert accuracy(model.transform(mapped)) > 0.97


def test_probabilities_add_up_and_bad_rows_are_skipped(spark):
    rows = gen.interest_blocks(spark.range(100), "id").withColumn("score", F.col("user_interest_score").cast("double"))
    bad = rows.limit(1).withColumn("score", F.lit(None).cast("double"))
    scored = md.class_probabilities(rows, rows.unionByName(bad), ["score", "user_rating"], "class").withColumn(
        "total", F.aggregate(F.map_values("probability"), F.lit(0.0), lambda a, b: a + b))
    assert scored.count() == 300 and md.skipped_rows(rows.unionByName(bad), ["score"]) == 1
    assert scored.filter("abs(total - 1) > 1e-9").count() == 0
    assert accuracy(scored.withColumn("prediction", F.col("predicted_class")), "class") > 0.8


def test_model_is_loaded_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return 2.0

    score = md.scoring_udf(load, lambda m, frame: frame.iloc[:, 0] * m + frame.iloc[:, 1])
    rows = spark.range(0, 50000, 1, 3).select("id", score(F.col("id"), F.lit(1)).alias("s"))
    assert rows.agg(F.sum("s")).first()[0] == 2 * sum(range(50000)) + 50000
    assert loads.value == 3


def test_train_job(spark, tmp_path):
    source = str(tmp_path / "houses")
    rows = gen.regression_table(spark.range(400), "id", [5.0, 2.0], categories=0).withColumn(
        "kind", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "a").otherwise("b")).withColumn(
        "x2", F.when(F.col("id") % 7 != 0, F.col("x2")))
    rows.write.parquet(source)
    out = md.train_job(spark, source, "y", str(tmp_path / "job"), "linear_regression", keys=["id"])
    train, test = spark.read.parquet(out["train_table"]), spark.read.parquet(out["test_table"])
    assert train.count() + test.count() == 400 and out["RMSE"] == pytest.approx(out["MSE"] ** 0.5)
    from pyspark.ml import PipelineModel

    unseen = test.withColumn("kind", F.lit("never seen"))
    model = PipelineModel.load(out["model_path"])
    assert model.transform(unseen).count() == test.count()
    md.batch_score(model, test, str(tmp_path / "scored"))
    assert "prediction" in spark.read.parquet(str(tmp_path / "scored")).columns


def test_registry_round_trip(spark, classes, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))
    model = md.fit(classes["train"], "decision_tree", X, "y")
    registry.log_model(model, "shop", "v1", "first", {"accuracy": 0.9})
    registry.log_model(md.fit(classes["train"], "decision_tree", X, "y", maxDepth=1), "shop", "v2")
    assert registry.versions("shop") == ["v1", "v2"] and registry.default_version("shop") == "v1"
    registry.set_default("shop", "v2")
    assert registry.show_models().first()["default_version"] == "v2"
    assert registry.describe("shop", "v1")["metrics"] == {"accuracy": 0.9}
    pinned = registry.load("shop", "v1").transform(classes["test"])
    assert accuracy(pinned) == accuracy(model.transform(classes["test"]))
    with pytest.raises(KeyError):
        registry.set_default("shop", "v9")
    with pytest.raises(Exception):
        registry.log_model(model, "shop", "v1")


def test_generated_values_do_not_depend_on_partitions(spark):
    a = gen.people(spark.range(100).repartition(5), "id").collect()
    b = gen.people(spark.range(100).coalesce(1), "id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and all(r["email"].endswith("@example.com") for r in a)


def test_text_jobs(spark, tmp_path):
    words = {"positive": "good great fine lovely superb", "negative": "bad awful poor dull horrid"}
    rows = [(i, " ".join(words[s].split()[j] for j in (i % 5, (i + 2) % 5)) + f" film number{i} the the", s)
            for i, s in enumerate(["positive", "negative"] * 40)]
    df = spark.createDataFrame(rows, "id int, review string, sentiment string")
    source, path = str(tmp_path / "reviews"), str(tmp_path / "model")
    df.write.parquet(source)
    out = ti.train_text_job(spark, source, "review", "sentiment", "positive", path, max_share=0.5, maxIter=10)
    assert out["status"] == "SUCCESS" and out["accuracy"] > 0.95
    terms = {r["term"] for r in ti.TextClassifier.load(spark, path).weights.collect()}
    assert "the" not in terms and "good" in terms and "number3 the" in terms
    assert ti.score_text_job(spark, source, "review", "sentiment", "positive", path)["accuracy"] == out["accuracy"]


def test_people_are_appended(spark, tmp_path):
    path = str(tmp_path / "people")
    gen.people_job(spark, 10, path)
    gen.people_job(spark, 5, path, first_id=10)
    assert spark.read.parquet(path).select("id").distinct().count() == 15
