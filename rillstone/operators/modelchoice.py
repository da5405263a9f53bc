"""Automatic choice of a classifier: candidates scored on hashed folds, the best one fitted again on all rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions.columns import uniform
from rillstone.operators.models import ESTIMATORS, assembler, counted, in_pieces
from rillstone.session import stage


@dataclass(frozen=True)
class Candidate:
    """An estimator by name, with its settings."""

    estimator: str
    params: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        settings = ",".join(f"{k}={v}" for k, v in sorted(self.params.items()))
        return f"{self.estimator}({settings})" if settings else self.estimator


DEFAULT = [
    Candidate("logistic_regression"), Candidate("decision_tree"), Candidate("random_forest", {"numTrees": 20}),
    Candidate("gradient_boosting", {"maxIter": 20}),
]
# these take two classes only; more are told apart one against the rest
_BY_CLASS = {"gradient_boosting": "gradient_boosting_classes", "linear_svm": "linear_svm_classes"}


@dataclass
class Choice:
    """The chosen candidate, what each one scored on each fold, and the model fitted on all rows."""

    candidate: Candidate
    scores: DataFrame
    model: PipelineModel
    classes: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        """Rows with the predicted class; rows with a missing feature are left out."""
        return self.model.transform(df).select(*df.columns, "predicted_class")

    def probabilities(self, df: DataFrame) -> DataFrame:
        """Rows with the predicted class and an object of class probabilities.

        A model that gives one margin per class has them turned into shares by the logistic function.
        """
        scored = self.model.transform(df)
        if "probability" in scored.columns:
            shares = vector_to_array("probability")
        else:
            odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-m)))
            total = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
            shares = F.transform(odds, lambda v: v / total)
        names = F.array(*[F.lit(c) for c in self.classes])
        return scored.select(*df.columns, "predicted_class", F.map_from_arrays(names, shares).alias("probability"))


def choose(
    train: DataFrame, features: list[str], label: str, keys: list[str], candidates: list[Candidate] | None = None,
    folds: int = 3, seed: int = 0,
) -> Choice:
    """Score every candidate on every fold by accuracy and refit the best; of equal ones the first given.

    A row's fold is a hash of its key, so it does not change with layout or
    retries. Rows without a label or a feature do not count. Equal rows of a fold
    are stored once, with their number as weight, and read by all fits;
    candidates times folds models are fitted.
    """
    spark = train.sparkSession
    candidates = DEFAULT if candidates is None else candidates
    if folds < 2 or not candidates:
        raise ValueError("at least two folds and one candidate")
    labelled = train.filter(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("string"))
    indexer = StringIndexer(inputCol="_label", outputCol="_target", stringOrderType="alphabetAsc").fit(labelled)
    classes = list(indexer.labels)
    gather = assembler(features, "skip")
    fold = F.floor(uniform(seed, *keys) * folds).cast("int")
    cells = counted(indexer.transform(labelled.withColumn("_fold", fold)).select(*features, "_target", "_fold"))
    rows = stage(gather.transform(cells).select("features", "_target", "_fold", "_weight"))
    present = sorted(r[0] for r in rows.select("_fold").distinct().collect())
    if len(present) < 2:
        raise ValueError("all rows fall into one fold")

    def estimator(c: Candidate):
        name = _BY_CLASS.get(c.estimator, c.estimator) if len(classes) > 2 else c.estimator
        return ESTIMATORS[name](labelCol="_target", weightCol="_weight", **c.params)

    def drawn(c: Candidate, part: DataFrame) -> DataFrame:
        return in_pieces(part) if c.estimator == "random_forest" else part

    found = []
    for i, c in enumerate(candidates):
        for k in present:
            model = estimator(c).fit(drawn(c, rows.filter(F.col("_fold") != k)))
            hit = F.when(F.col("prediction") == F.col("_target"), F.col("_weight")).otherwise(0.0)
            n, right = model.transform(rows.filter(F.col("_fold") == k)).agg(F.sum("_weight"), F.sum(hit)).first()
            found.append((i, c.name, k, int(n), int(right)))
    total = sum(r[3] for r in found if r[0] == 0)
    right = [sum(r[4] for r in found if r[0] == i) for i in range(len(candidates))]
    best = max(range(len(candidates)), key=lambda i: (right[i], -i))
    scores = spark.createDataFrame([r[1:] for r in found], "candidate string, fold int, n long, hits long").withColumn(
        "chosen", F.col("candidate") == candidates[best].name).withColumn("accuracy", F.col("hits") / F.col("n"))
    if not total:
        raise ValueError("no row has all features")
    fitted = estimator(candidates[best]).fit(drawn(candidates[best], rows))
    names = IndexToString(inputCol="prediction", outputCol="predicted_class", labels=classes)
    return Choice(candidates[best], scores, PipelineModel([gather, fitted, names]), classes)
