"""Scores of predictions held next to their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.aggregates import mode
from rillstone.session import stage


def mismatches(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.filter(F.col(label) != F.col(prediction))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Count for every pair of classes, zero where a pair does not occur."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))
    # the grid grows with the number of classes only
    classes = counts.agg(F.array_sort(F.array_distinct(F.concat(F.collect_set("label"), F.collect_set("prediction")))).alias("c"))
    grid = classes.select("c", F.explode("c").alias("label")).select("label", F.explode("c").alias("prediction"))
    return grid.join(counts, ["label", "prediction"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages.

    A ratio with a zero denominator is 0.
    """
    cells = confusion(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("count").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("count").alias("predicted"), F.lit(0).cast("long").alias("hits")),
    )
    per_class = cells.select(F.inline(sides)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    scored = per_class.select(
        F.col("class").cast("string").alias("class"),
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2.0 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support", "hits",
    )
    scores = ["precision", "recall", "f1"]
    summary = scored.agg(
        F.sum("support").alias("n"), F.sum("hits").alias("hits"),
        *[F.avg(s).alias(f"{s}_m") for s in scores],
        *[ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"{s}_w") for s in scores],
    )
    accuracy = ratio(F.col("hits"), F.col("n"))
    rows = F.array(
        F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(s) for s in scores], F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), *[F.col(f"{s}_m").alias(s) for s in scores], F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"{s}_w").alias(s) for s in scores], F.col("n").alias("support")),
    )
    return scored.drop("hits").unionByName(summary.select(F.inline(rows)))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(hit.alias("accuracy"), (1 - hit).alias("error_rate"), F.count(F.lit(1)).alias("n"))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Error measures; the percentage error leaves out zero labels and says how many."""
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    mse = F.avg(e * e)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        F.avg(F.when(y != 0, F.abs(e) / F.abs(y))).alias("mape"), F.count_if(y == 0).alias("zero_labels"),
        (1 - F.try_divide(F.var_pop(e), F.var_pop(y))).alias("explained_variance"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
    )


def cluster_agreement(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Confusion after giving each cluster the label most of its rows have."""
    majority = stage(mode(df, [cluster], label, name="_majority"))
    return confusion(df.join(majority, cluster), label, "_majority")
