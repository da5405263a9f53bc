"""Model fitting, scoring and storage with Spark ML: training data is never collected."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml import classification as C
from pyspark.ml import clustering, regression
from pyspark.ml.feature import OneHotEncoder, QuantileDiscretizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.evaluate import regression_metrics
from rillstone.operators.select import numeric_and_text_columns, split
from rillstone.operators.transformers import FrequentImputer, MedianImputer, PopulationScaler
from rillstone.session import stage

# ---------------------------------------------------------------- estimators by name

ESTIMATORS: dict[str, Callable[..., Estimator]] = {
    "linear_regression": regression.LinearRegression,
    "forest_regression": lambda **kw: regression.RandomForestRegressor(**{"numTrees": 100, "seed": 42, **kw}),
    "logistic_regression": C.LogisticRegression,
    "decision_tree": lambda **kw: C.DecisionTreeClassifier(**{"seed": 42, **kw}),
    "random_forest": lambda **kw: C.RandomForestClassifier(**{"numTrees": 100, "seed": 42, **kw}),
    "gradient_boosting": lambda **kw: C.GBTClassifier(**{"seed": 42, **kw}),
    "linear_svm": C.LinearSVC,
    # for more than two classes: one model per class against the rest
    "gradient_boosting_classes": lambda labelCol="label", weightCol=None, **kw: C.OneVsRest(
        labelCol=labelCol, weightCol=weightCol, classifier=C.GBTClassifier(**{"seed": 42, **kw})),
    "linear_svm_classes": lambda labelCol="label", weightCol=None, **kw: C.OneVsRest(
        labelCol=labelCol, weightCol=weightCol, parallelism=4, classifier=C.LinearSVC(**kw)),
    "k_means": lambda **kw: clustering.KMeans(**{"k": 2, "seed": 42, **kw}),
}


def assembler(features: list[str], invalid: str = "error") -> VectorAssembler:
    """Feature columns to one vector; ``invalid="skip"`` leaves out rows it cannot use."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid)


def fit(train: DataFrame, name: str, features: list[str], label: str | None = None, invalid: str = "error", **params) -> PipelineModel:
    """Fit a named estimator on plain columns."""
    if label is not None:
        params["labelCol"] = label
    return Pipeline(stages=[assembler(features, invalid), ESTIMATORS[name](**params)]).fit(train)


# ---------------------------------------------------------------- trees over counted cells

_BINS = 32  # the bins per feature that Spark's trees work with
_DISTINCT = 64  # a feature of this many values or fewer keeps them
_DRAWN = 250_000  # pieces a forest draws its samples from, at least where there are as many rows


def counted(rows: DataFrame, weight: str = "_weight") -> DataFrame:
    """Distinct rows with their number."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias(weight))


def in_pieces(cells: DataFrame, weight: str = "_weight", pieces: int = _DRAWN) -> DataFrame:
    """Counted rows parted into pieces of equal weight, single rows while there are no more than ``pieces``.

    A bootstrap draws pieces, so that also a cell of many rows is drawn often or seldom.
    """
    total = cells.agg(F.sum(weight)).first()[0] or 0.0
    size = max(1.0, total / pieces)
    parts = F.ceil(F.col(weight) / size).cast("int")
    cut = cells.withColumn("_part", F.explode(F.sequence(F.lit(1), parts)))
    return cut.withColumn(weight, F.col(weight) / parts).drop("_part")


def fit_trees(train: DataFrame, name: str, features: list[str], label: str, **params) -> PipelineModel:
    """Fit a named tree model on counted cells of its features' bins in place of single rows.

    Trees see a feature through at most 32 bins, so the number of rows per bins
    and label holds all they use. A feature of more than 64 values is cut at its
    quantiles first; the cut is part of the model. What is fitted on is then
    limited by the bins, however many rows there are.
    """
    many = train.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    wide = [c for c in features if many[c] > _DISTINCT]
    stages, used = [], [f"{c}__bin" if c in wide else c for c in features]
    for c in wide:
        stages.append(QuantileDiscretizer(inputCol=c, outputCol=f"{c}__bin", numBuckets=_BINS, handleInvalid="error").fit(train))
    rows = PipelineModel(stages).transform(train).select(*used, label)
    cells = stage(counted(rows))
    if name.startswith("forest") or name == "random_forest":
        cells = in_pieces(cells)
    gather = assembler(used)
    fitted = ESTIMATORS[name](labelCol=label, weightCol="_weight", **params).fit(gather.transform(cells))
    return PipelineModel([*stages, gather, fitted])


def fit_vectors(train: DataFrame, name: str, label: str | None = None, **params):
    """Fit a named estimator on an existing ``features`` vector."""
    if label is not None:
        params["labelCol"] = label
    return ESTIMATORS[name](**params).fit(train)


def predict(model: Transformer, df: DataFrame) -> DataFrame:
    return model.transform(df)


def skipped_rows(df: DataFrame, features: list[str]) -> int:
    """How many rows a skipping model leaves out."""
    return df.count() - df.dropna(subset=features).count()


def coefficients(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    fitted = model.stages[-1]
    rows = [("(intercept)", float(fitted.intercept)), *zip(features, map(float, fitted.coefficients))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def feature_importance(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """Importances scaled to a sum of 1, most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    total = weights.sum() or 1.0
    rows = [(f, float(w / total)) for f, w in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def class_probabilities(
    train: DataFrame, scored: DataFrame, features: list[str], label: str, name: str = "logistic_regression", **params,
) -> DataFrame:
    """Predicted class and an object of class probabilities, for any number of classes.

    Rows with a missing feature are skipped, as ``on_error: skip`` does.
    """
    indexer = StringIndexer(inputCol="_label", outputCol="_target", stringOrderType="alphabetAsc")
    pipe = Pipeline(stages=[indexer, assembler(features, "skip"), ESTIMATORS[name](labelCol="_target", **params)])
    model = pipe.fit(train.withColumn("_label", F.col(label).cast("string")))
    classes = F.array(*[F.lit(c) for c in model.stages[0].labels])
    probabilities = vector_to_array("probability")
    rows = scored
    for step in model.stages[1:]:
        rows = step.transform(rows)
    return rows.select(
        *scored.columns, F.get(classes, F.col("prediction").cast("int")).alias("predicted_class"),
        F.map_from_arrays(classes, probabilities).alias("probability"))


def random_fourier_features(df: DataFrame, vector: str, dims: int, size: int = 256, gamma: float | None = None, seed: int = 0, output: str = "features") -> DataFrame:
    """Map vectors so that inner products approximate an RBF kernel (Rahimi and Recht, 2007)."""
    rng = np.random.default_rng(seed)
    gamma = 1.0 / dims if gamma is None else gamma
    w = rng.normal(scale=math.sqrt(2 * gamma), size=(dims, size))
    b = rng.uniform(0, 2 * math.pi, size=size)

    @F.pandas_udf("array<double>")
    def project(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
        return pd.Series(list(math.sqrt(2.0 / size) * np.cos(x @ w + b)))

    return df.withColumn(output, array_to_vector(project(F.col(vector).cast("array<double>"))))


# ---------------------------------------------------------------- mixed-type pipeline

def preprocessing(numeric: list[str], text: list[str]) -> list:
    """Stages: fill numbers with their median and scale them, fill texts with the most frequent one and one-hot encode them, assemble."""
    stages: list = []
    if numeric:
        filled, scaled = [f"{c}__f" for c in numeric], [f"{c}__s" for c in numeric]
        stages += [MedianImputer(inputCols=numeric, outputCols=filled), PopulationScaler(inputCols=filled, outputCols=scaled),
                   VectorAssembler(inputCols=scaled, outputCol="_scaled")]
    if text:
        stages.append(FrequentImputer(inputCols=text, outputCols=[f"{c}__t" for c in text]))
        stages += [StringIndexer(inputCol=f"{c}__t", outputCol=f"{c}__i", handleInvalid="keep", stringOrderType="alphabetAsc") for c in text]
    if text:
        # the slot StringIndexer keeps for unseen values is the last one, which is dropped: they become zeros
        stages.append(OneHotEncoder(inputCols=[f"{c}__i" for c in text], outputCols=[f"{c}__o" for c in text], dropLast=True))
    parts = (["_scaled"] if numeric else []) + [f"{c}__o" for c in text]
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def fit_mixed(train: DataFrame, name: str, numeric: list[str], text: list[str], label: str, **params) -> PipelineModel:
    """Fit a named estimator on prepared numeric and text columns."""
    return Pipeline(stages=[*preprocessing(numeric, text), ESTIMATORS[name](labelCol=label, **params)]).fit(train)


def train_job(
    spark: SparkSession, source: str, target: str, folder: str, name: str = "forest_regression", keys: list[str] | None = None,
    weights: tuple[float, float] = (0.8, 0.2), seed: int = 82, **params,
) -> dict:
    """Split a Parquet table, store both parts, fit, store the model, and score the test part."""
    df = spark.read.parquet(source)
    numeric, text = numeric_and_text_columns(df.drop(*(keys or [])), target)
    parts = split(df, {"train": weights[0], "test": weights[1]}, keys or df.columns, seed)
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d-%H%M%S")
    tables = {p: f"{folder}/{p}" for p in parts}
    for p, rows in parts.items():
        rows.write.mode("overwrite").parquet(tables[p])
    train, test = (spark.read.parquet(tables[p]) for p in ("train", "test"))
    model = fit_mixed(train, name, numeric, text, target, **params)
    path = f"{folder}/models/{stamp}"
    model.write().overwrite().save(path)
    scores = regression_metrics(model.transform(test), target, "prediction").first()
    return {"MSE": scores["mse"], "RMSE": scores["rmse"], "model_path": path,
            "train_table": tables["train"], "test_table": tables["test"]}


def batch_score(model: Transformer, source: DataFrame, path: str, mode_: str = "overwrite") -> None:
    """Score a table and write it with its predictions."""
    scored = model.transform(source)
    scored.select(*source.columns, "prediction").write.mode(mode_).parquet(path)


# ---------------------------------------------------------------- models that Spark ML cannot score

def scoring_udf(load: Callable[[], object], score: Callable[[object, pd.DataFrame], np.ndarray]) -> Callable[..., Column]:
    """Vectorised scoring by a model that each task loads once, before its first batch."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            frame = pd.concat(columns, axis=1)
            yield pd.Series(np.asarray(score(model, frame), dtype=np.float64))

    return run


