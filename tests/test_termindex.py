"""The term index against plain Python, and scoring by join against the vectors' own products."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators import termindex as ti

TEXTS = ["Red fox runs", "red red fox", "a don't-know fox", None, "", "!!", "fox den fox den", "Über straße fox", "blue hen", "red hen runs far"]


def terms(text):
    words = re.findall(r"[^\W]['\w]*\w|'['\w]*\w", (text or "").lower())
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)


@pytest.mark.parametrize("share, least", [(1.0, 1), (0.5, 1), (0.3, 2)])
def test_index(docs, share, least):
    counts = Counter(t for text in TEXTS for t in terms(text))
    want = sorted((t for t, n in counts.items() if least <= n <= share * len(TEXTS)), key=lambda t: t.encode())
    got = ti.term_index(docs, ti.text_terms("text"), share, least).orderBy("code").collect()
    assert [r["term"] for r in got] == want and [r["code"] for r in got] == list(range(len(want)))
    assert [r["docs"] for r in got] == [counts[t] for t in want]


def test_vectors_hold_the_indexed_terms(docs):
    index = ti.term_index(docs, ti.text_terms("text"), 0.5)
    code = {r["term"]: r["code"] for r in index.collect()}
    for r in ti.term_vectors(docs, ti.text_terms("text"), index, len(code)).collect():
        assert r["features"].size == len(code)
        assert r["features"].indices.tolist() == sorted(code[t] for t in terms(r["text"]) if t in code)
        assert set(r["features"].values.tolist()) <= {1.0}


def test_scoring_by_join_equals_the_product(spark, docs, tmp_path):
    train = docs.withColumn("y", F.coalesce(F.col("text").contains("fox").cast("int"), F.lit(0)))
    model = ti.TextClassifier.fit(train, "text", "y", max_share=0.9, regParam=0.01, maxIter=30)
    weights = {r["term"]: r["weight"] for r in model.weights.collect()}
    model.save(str(tmp_path / "m"))
    again = ti.TextClassifier.load(spark, str(tmp_path / "m"))
    scored = again.transform(docs.withColumn("prediction_before", F.lit(1)))
    assert scored.columns == ["id", "text", "prediction_before", "margin", "prediction"] and scored.count() == len(TEXTS)
    for r in scored.collect():
        assert r["margin"] == pytest.approx(np.sum([weights.get(t, 0.0) for t in terms(r["text"])]) + model.intercept)
        assert r["prediction"] == float(r["margin"] > 0)


def test_repeated_rows_and_no_terms(spark, docs):
    index = ti.term_index(docs, ti.text_terms("text"), 1.0)
    twice = docs.unionByName(docs)
    assert ti.term_vectors(twice, ti.text_terms("text"), index, index.count()).count() == 2 * len(TEXTS)
    with pytest.raises(ValueError, match="no term"):
        ti.TextClassifier.fit(docs.filter("id = 4").withColumn("y", F.lit(1)), "text", "y")
    empty = docs.limit(0)
    assert ti.term_index(empty, ti.text_terms("text")).count() == 0
