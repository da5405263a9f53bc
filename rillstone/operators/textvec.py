"""Bags of words, TF-IDF and naive Bayes in long form: one row per document and term.

The long form needs no vocabulary on the driver and no limit on its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.session import in_parts, stage

ROWS_OF_A_PART = 2_000  # some million terms of words and pairs


def terms_long(df: DataFrame, key: str, terms: Column) -> DataFrame:
    return df.select(key, F.explode(terms).alias("term"))


def bag_of_words(df: DataFrame, key: str, terms: Column) -> DataFrame:
    """Count of each term per document.

    The texts are brought together by key before they are taken apart: they are
    smaller than their terms, which are then counted where they are.
    """
    return terms_long(df.repartition(key), key, terms).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def document_frequency(df: DataFrame, key: str, terms: Column, max_share: float = 1.0) -> DataFrame:
    """Number of documents per term, without terms in more than ``max_share`` of them.

    Repeats are removed inside each document before anything is counted. The
    documents are dealt to parts of ``ROWS_OF_A_PART`` first: a task counts its
    terms in a table in memory, which in a task of the whole of a large split
    outgrows that and is sorted and spilled.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = terms_long(in_parts(df, ROWS_OF_A_PART), key, F.array_distinct(terms)).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.filter(F.col("df") <= total * max_share)


def bag_statistics(bag: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Documents, vocabulary size, non-zero cells and their share of the matrix in percent."""
    docs = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return bag.agg(
        docs.alias("documents"), F.count_distinct("term").alias("vocabulary"), F.count(F.lit(1)).alias("non_zero"),
    ).withColumn("density_pct", F.try_divide(F.col("non_zero") * 100.0, F.col("documents") * F.col("vocabulary")))


def tf_idf(bag: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Counts weighted by ln((1 + docs) / (1 + df)) + 1, each document scaled to length 1."""
    docs = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    bag = stage(bag)  # read twice: the texts should not be taken apart twice
    df = bag.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = bag.join(df, "term").withColumn(
        "w", F.col("n") * (F.ln((docs + 1.0) / (F.col("df") + 1.0)) + 1.0))
    # a document's terms come from one text, so this group is as small as a row of the input
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "n", "df", (F.col("w") / norm).alias("tfidf"))


class NaiveBayes:
    """Multinomial naive Bayes over (document, term, weight) rows.

    The model is a table with one row per term holding the log-probability of
    the term in each class, so neither the vocabulary nor a document has to
    pass through the driver; only the class list and its counts do.
    """

    def __init__(self, classes: list, log_prior: dict, model: DataFrame, weight: str):
        self.classes, self.log_prior, self.model, self.weight = classes, log_prior, model, weight

    @classmethod
    def fit(cls, bag: DataFrame, labels: DataFrame, key: str, label: str, weight: str = "n", smoothing: float = 1.0):
        import math

        per_class = {r[0]: r[1] for r in labels.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
        classes, total = sorted(per_class), sum(per_class.values())
        log_prior = {c: math.log(per_class[c] / total) for c in classes}

        rows = bag.join(labels.select(key, label), key)
        by_term = stage(rows.groupBy("term").agg(*[
            F.sum(F.when(F.col(label) == c, F.col(weight)).otherwise(0)).cast("double").alias(f"c{i}")
            for i, c in enumerate(classes)]))
        totals = by_term.agg(F.struct(
            F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(classes))]).alias("t")).scalar()
        model = by_term.withColumn("_t", totals).select("term", *[
            F.ln((F.col(f"c{i}") + smoothing) / (F.col(f"_t.c{i}") + F.col("_t.v") * smoothing)).alias(f"lp{i}")
            for i in range(len(classes))])
        return cls(classes, log_prior, model, weight)

    def predict(self, documents: DataFrame, bag: DataFrame, key: str) -> DataFrame:
        """Most likely class of every document; terms unseen in training count for nothing."""
        scores = bag.join(self.model, "term").groupBy(key).agg(*[
            F.sum(F.col(self.weight) * F.col(f"lp{i}")).alias(f"s{i}") for i in range(len(self.classes))])
        ranked = F.array(*[
            F.struct((F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + self.log_prior[c]).alias("score"),
                     F.lit(-i).alias("first"), F.lit(c).alias("cls"))
            for i, c in enumerate(self.classes)])
        joined = documents.select(key).join(scores, key, "left")
        return joined.select(key, F.array_max(ranked)["cls"].alias("prediction"))
