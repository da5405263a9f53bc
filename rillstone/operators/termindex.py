"""An index of all terms of a corpus, sparse vectors by its numbers, and a linear text classifier over it.

The index is a stored table with a number for each term, made by ranges; no
vocabulary passes through the driver and no two terms share a number. Terms that
are too common or too rare are not in it, so a join with it leaves them out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions.text import WORDS_WITH_APOSTROPHE, tokens, with_bigrams
from rillstone.operators import widesvm
from rillstone.operators.evaluate import accuracy, regression_metrics
from rillstone.operators.numbering import number_rows
from rillstone.operators.postings import count_terms, look_up, postings, row_count
from rillstone.session import stage

DENSE_TERMS = 1 << 18  # weights that training holds in each task and on the driver

def text_words(text: str) -> Column:
    """Words of a text, in its order; NULL has none."""
    return F.coalesce(tokens(text, WORDS_WITH_APOSTROPHE), F.array().cast("array<string>"))


def text_terms(text: str) -> Column:
    """Distinct words and word pairs of a text; NULL has none."""
    return F.array_distinct(with_bigrams(text_words(text)))


def text_postings(df: DataFrame, text: str, key: str) -> DataFrame:
    """``postings`` of ``text_terms``, with the pairs made once a part and not once a text."""
    return postings(df, text_words(text), key, pairs=True)


def term_index(df: DataFrame, terms: Column, max_share: float = 0.02, min_docs: int = 1, held: DataFrame | None = None) -> DataFrame:
    """``term, code, docs``: terms in at least ``min_docs`` rows and at most ``max_share`` of them, numbered from 0. Stored.

    ``held`` are the rows' ``postings``, if their terms were taken apart before.
    """
    held = postings(df, terms, F.lit(0)) if held is None else held
    counts = stage(count_terms(held, min_docs, row_count(held) * max_share))
    return stage(number_rows(counts, ["term"], "code", start=0).select("term", "code", "docs"))


def coded(df: DataFrame, terms: Column, index: DataFrame, key: str, *more: str, held: DataFrame | None = None) -> DataFrame:
    """``key, code`` and ``more`` (whole numbers) of the index: one row for each indexed term of each row; terms beyond the index are lost.

    ``held`` are the rows' ``postings`` by ``key``, if their terms were taken apart before; else the terms are joined one by one.
    """
    if held is not None:
        return look_up(held, index, key, "code", *more)
    known = index.select("term", "code", *more)
    return df.select(key, F.explode(terms).alias("term")).join(known, "term").select(key, "code", *more)


def term_vectors(df: DataFrame, terms: Column, index: DataFrame, size: int, output: str = "features") -> DataFrame:
    """Rows with a sparse vector of ones at their terms' numbers; a row without an indexed term has an empty one. Stored."""
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()))
    codes = coded(rows, terms, index, "_row").groupBy("_row").agg(F.array_sort(F.collect_list(F.col("code").cast("int"))).alias("_codes"))
    at = F.coalesce("_codes", F.array().cast("array<int>"))
    # written in the parts a vector is stored as and read back as one, so that no row passes through Python
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).cast("int").alias("size"), at.alias("indices"),
                     F.transform(at, lambda _: F.lit(1.0)).alias("values"))
    held = rows.join(codes, "_row", "left").withColumn(output, parts).drop("_row", "_codes")
    schema = T.StructType([T.StructField(f.name, VectorUDT() if f.name == output else f.dataType) for f in held.schema.fields])
    return stage(held, schema)


class TextClassifier:
    """Linear support-vector machine over word and word-pair presence.

    Training keeps one dense weight per term on the driver up to ``DENSE_TERMS``
    terms, and one multiplier per row beyond (``widesvm``). Scoring joins terms
    with their weights and adds up, whatever the vocabulary.
    """

    def __init__(self, weights: DataFrame, intercept: float, text: str):
        self.weights, self.intercept, self.text = weights, intercept, text

    @classmethod
    def fit(
        cls, train: DataFrame, text: str, label: str, max_share: float = 0.02, min_docs: int = 1, **params,
    ) -> TextClassifier:
        spark = train.sparkSession
        held = text_postings(train, text, label)
        index = term_index(train, text_terms(text), max_share, min_docs, held)
        size = index.count()
        if not size:
            raise ValueError("no term lies between the least and the largest share")
        if size > DENSE_TERMS and params.get("regParam") and set(params) <= {"regParam", "maxIter", "tol", "standardization"}:
            return cls(*widesvm.fit(held, index, **params), text)
        rows = term_vectors(train.select(label, text), text_terms(text), index, size).select(label, "features")
        model = LinearSVC(labelCol=label, **params).fit(rows)
        weights = pd.DataFrame({"code": np.arange(size, dtype=np.int64), "weight": model.coefficients.toArray()})
        learned = index.join(spark.createDataFrame(weights), "code").select("term", "weight")
        return cls(stage(learned), float(model.intercept), text)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with the sum of their terms' weights, ``margin``, and the ``prediction``."""
        rows = stage(df.withColumn("_row", F.monotonically_increasing_id()))
        if self.weights.count() > DENSE_TERMS:
            each = look_up(text_postings(rows, self.text, "_row"), self.weights, "_row", "weight")
        else:
            each = rows.select("_row", F.explode(text_terms(self.text)).alias("term")).join(self.weights, "term")
        sums = each.groupBy("_row").agg(F.sum("weight").alias("_sum"))
        margin = F.coalesce("_sum", F.lit(0.0)) + self.intercept
        return rows.join(sums, "_row", "left").withColumn("margin", margin).withColumn(
            "prediction", (F.col("margin") > 0).cast("double")).drop("_row", "_sum")

    def save(self, path: str) -> None:
        self.weights.write.parquet(f"{path}/weights")
        spark = self.weights.sparkSession
        one = spark.createDataFrame([(self.text, self.intercept)], "text string, intercept double")
        one.coalesce(1).write.parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        model = spark.read.parquet(f"{path}/model").first()
        return cls(spark.read.parquet(f"{path}/weights"), model["intercept"], model["text"])


def train_text_job(spark: SparkSession, source: str, text: str, label: str, positive: str, path: str, **params) -> dict:
    """Fit a text classifier on a Parquet table and store it; the label is ``positive`` or anything else."""
    rows = spark.read.parquet(source).withColumn("_flag", (F.col(label) == positive).cast("int"))
    model = TextClassifier.fit(rows, text, "_flag", **params)
    model.save(path)
    return {"status": "SUCCESS", "accuracy": accuracy(model.transform(rows), "_flag", "prediction").first()["accuracy"],
            "model_path": path}


def score_text_job(spark: SparkSession, source: str, text: str, label: str, positive: str, path: str) -> dict:
    """Score a Parquet table with a stored text classifier."""
    rows = spark.read.parquet(source).withColumn("_flag", (F.col(label) == positive).cast("int"))
    scored = TextClassifier.load(spark, path).transform(rows)
    return {"accuracy": accuracy(scored, "_flag", "prediction").first()["accuracy"],
            "r2_score": regression_metrics(scored, "_flag", "prediction").first()["r2"]}
