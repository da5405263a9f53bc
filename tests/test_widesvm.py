"""The machine with a multiplier per row against dense fits of the same objective."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from rillstone.operators import termindex as ti
from rillstone.operators import widesvm
from tests.test_postings import terms


@pytest.fixture(scope="module")
def train(spark):
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(400):
        y = int(draw.random() < 0.3)
        own = [f"w{int(k) * 2 + y}" for k in draw.integers(0, 60, 4)]
        rows.append((y, " ".join(own + [f"n{int(k)}" for k in draw.integers(0, 200, 4)])))
    rows += rows[:60] + [(1, ""), (0, None), (0, rows[0][1]), (1, rows[0][1])]
    return spark.createDataFrame(rows, "y int, text string").repartition(4)


def _objective(x, y, w, b, reg):
    deviations = x.std(axis=0, ddof=1)
    return np.maximum(0, 1 - (2 * y - 1) * (x @ w + b)).mean() + reg / 2 * ((w * deviations) ** 2).sum()


def test_wide_machine_reaches_the_dense_machines_least_objective(spark, train, monkeypatch):
    monkeypatch.setattr(ti, "DENSE_TERMS", 0)
    reg = 0.01
    model = ti.TextClassifier.fit(train, "text", "y", max_share=0.5, min_docs=2, regParam=reg, maxIter=60, tol=0.02)
    held = train.collect()
    index = {r["term"]: r["weight"] for r in model.weights.collect()}
    at = {t: i for i, t in enumerate(index)}
    x, y = np.zeros((len(held), len(at))), np.array([r["y"] for r in held])
    for i, r in enumerate(held):
        x[i, [at[t] for t in terms(r["text"]) if t in at]] = 1
    w = np.array(list(index.values()))
    dense = LinearSVC(labelCol="y", regParam=reg, maxIter=200, tol=1e-8).fit(
        ti.term_vectors(train, ti.text_terms("text"), spark.createDataFrame(list(at.items()), "term string, code int"), len(at)))
    least = _objective(x, y, dense.coefficients.toArray(), dense.intercept, reg)
    assert _objective(x, y, w, model.intercept, reg) <= least + 0.02
    for r in model.transform(train).collect():
        assert r["margin"] == pytest.approx(sum(index.get(t, 0.0) for t in terms(r["text"])) + model.intercept)


def test_wide_machine_keeps_no_vector_per_row(train, monkeypatch):
    monkeypatch.setattr(ti, "DENSE_TERMS", 0)
    monkeypatch.setattr(ti, "term_vectors", None)
    monkeypatch.setattr(ti, "LinearSVC", None)
    assert ti.TextClassifier.fit(train, "text", "y", max_share=0.5, regParam=0.1, maxIter=3).weights.count() > 0


def test_wide_machine_of_one_class_and_of_other_labels(train, monkeypatch):
    monkeypatch.setattr(ti, "DENSE_TERMS", 0)
    model = ti.TextClassifier.fit(train.filter("y = 1"), "text", "y", max_share=0.9, regParam=0.1)
    assert model.transform(train).filter("prediction = 1").count() == train.count()
    for odd in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(ValueError, match="labels"):
            ti.TextClassifier.fit(train.withColumn("y", odd), "text", "y", max_share=0.9, regParam=0.1)


def test_solver_on_equal_rows_and_one_class():
    x = np.repeat(np.array([[1.0, 0, 1], [0, 1, 1]]), [50, 3], axis=0)
    y = np.repeat([1.0, -1.0], [50, 3])
    signed, b, gap = widesvm.solve(lambda v: x @ (x.T @ v), y, 0.01, 200, 1e-4)
    w = x.T @ signed
    value = np.maximum(0, 1 - y * (x @ w + b)).mean() + 0.005 * w @ w
    assert gap <= 1e-4 and value <= 0.01 + 1e-4 and signed.sum() == pytest.approx(0, abs=1e-9)
    assert widesvm.solve(lambda v: x @ (x.T @ v), -np.ones(53), 0.01, 5, 1e-4)[1] == -1.0
