"""Stored transformers with exact statistics, as stages of a Spark ML pipeline.

Spark ML's own imputer takes an approximate median and its scaler the sample
deviation; these take the exact median, the population's deviation and the most
frequent text. Fitted values are parameters, so a pipeline that holds them is
saved and loaded like any other.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.quantiles import exact_quantiles


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


class _Columns(HasInputCols, HasOutputCols):
    """Input columns and, in the same order, the columns that are added for them."""

    def _pairs(self) -> list[tuple[str, str]]:
        pairs = list(zip(self.getInputCols(), self.getOutputCols(), strict=True))
        if not pairs:
            raise ValueError("no input columns")
        return pairs


class _ColumnsEstimator(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _long(self, df: DataFrame, kind: str) -> DataFrame:
        """``column`` (its position) and ``value``: all inputs under each other, so one pass serves all of them."""
        cells = [F.struct(F.lit(i).alias("column"), _column(c).cast(kind).alias("value")) for i, c in enumerate(self.getInputCols())]
        return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("value is not null")

    def _each(self, found: DataFrame, *values: str) -> list[tuple]:
        """The values of each input column, in order; every column must hold one."""
        by_column = {r["column"]: tuple(r[v] for v in values) for r in found.collect()}  # one row per column
        missing = [c for i, c in enumerate(self.getInputCols()) if i not in by_column]
        if missing:
            raise ValueError(f"no value in {', '.join(missing)}")
        return [by_column[i] for i in range(len(self.getInputCols()))]

    def _made(self, model: Model, **values) -> Model:
        return model._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols(), **values)


def _floats(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toListFloat)


class MedianImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = _floats("medians", "value that takes the place of a missing one, by input column")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({
            out: F.coalesce(F.nanvl(_column(c).cast("double"), F.lit(None)), F.lit(m))
            for (c, out), m in zip(self._pairs(), self.getOrDefault(self.medians), strict=True)})


class MedianImputer(_ColumnsEstimator):
    """Missing numbers (NULL and NaN) become the exact median; an even number of values gives the mean of the middle two."""

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        rows = self._long(dataset, "double").filter(~F.isnan("value"))
        found = exact_quantiles(rows, "value", {"median": 0.5}, ["column"])
        return self._made(MedianImputerModel(), medians=[m for m, in self._each(found, "median")])


class PopulationScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    means = _floats("means", "mean by input column")
    deviations = _floats("deviations", "deviation by input column, 1 where there is none")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(self._pairs(), self.getOrDefault(self.means), self.getOrDefault(self.deviations), strict=True)
        return dataset.withColumns({out: (_column(c).cast("double") - m) / d for (c, out), m, d in fitted})


class PopulationScaler(_ColumnsEstimator):
    """Numbers less their mean, over the population's deviation; a constant column becomes 0, NULL stays NULL."""

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        rows = self._long(dataset, "double")
        found = self._each(rows.groupBy("column").agg(
            F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation")), "mean", "deviation")
        return self._made(PopulationScalerModel(), means=[m for m, _ in found], deviations=[d or 1.0 for _, d in found])


class FrequentImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    frequent = Param(Params._dummy(), "frequent", "text that takes the place of a missing one, by input column",
                     typeConverter=TypeConverters.toListString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({
            out: F.coalesce(_column(c).cast("string"), F.lit(m))
            for (c, out), m in zip(self._pairs(), self.getOrDefault(self.frequent), strict=True)})


class FrequentImputer(_ColumnsEstimator):
    """Missing texts become the most frequent one, of equally frequent ones the smallest."""

    def _fit(self, dataset: DataFrame) -> FrequentImputerModel:
        counts = self._long(dataset, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        # the most rows win; among equals the value that comes first
        most = counts.groupBy("column").agg(F.max("n").alias("n"))
        found = counts.join(most, ["column", "n"]).groupBy("column").agg(F.min("value").alias("value"))
        return self._made(FrequentImputerModel(), frequent=[v for v, in self._each(found, "value")])
