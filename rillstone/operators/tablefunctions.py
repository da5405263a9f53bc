"""Forecasts and anomaly flags as table functions of SQL.

    SELECT * FROM forecast(
      input_data => TABLE(daily) PARTITION BY store, series_colname => 'store',
      timestamp_colname => 'day', target_colname => 'total', forecasting_periods => 14)

A partition's rows go by once and leave only their sums of products, so a long
series costs time but no memory. The answers are those of ``seasons``.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, DateType, DoubleType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from rillstone.operators.seasons import KNOWN, Season, feature_matrix, solve
from rillstone.operators.series import z_score

_FIRST = dt.date(1970, 1, 1).toordinal()
_BOUNDS = [StructField(c, DoubleType()) for c in ("forecast", "lower_bound", "upper_bound")]


def _day(value) -> int:
    return value.toordinal() - _FIRST


def _names(text: str | None) -> list[str]:
    return [name.strip() for name in (text or "").split(",") if name.strip()]


def _seasons(text: str | None) -> tuple[Season, ...]:
    unknown = [name for name in _names(text) if name not in KNOWN]
    if unknown:
        raise ValueError(f"seasons are {', '.join(KNOWN)}, not {', '.join(unknown)}")
    return tuple(KNOWN[name] for name in _names(text))


def _checked(rows: AnalyzeArgument, names: list[AnalyzeArgument]) -> list[StructField]:
    """The fields of the table argument with these names."""
    fields = {f.name: f for f in rows.dataType.fields}
    for argument in names:
        for name in _names(argument.value):
            if name not in fields:
                raise ValueError(f"the table has no column {name}")
    return [fields[name] for argument in names for name in _names(argument.value)]


class Sums:
    """Summed products of (1, features, y), added up a few hundred rows at a time."""

    def __init__(self, seasons: tuple[Season, ...]):
        self.seasons = seasons
        size = 3 + 2 * sum(s.harmonics for s in seasons)
        self.products, self.days, self.values, self.low, self.high = np.zeros((size, size)), [], [], None, None

    def add(self, day: int, value: float) -> None:
        self.days.append(day)
        self.values.append(value)
        if len(self.days) >= 512:
            self._flush()

    def _flush(self) -> None:
        if self.days:
            day = np.array(self.days, float)
            rows = np.column_stack([np.ones(len(day)), feature_matrix(day, self.seasons), self.values])
            self.products += rows.T @ rows
            self.low = min(self.days) if self.low is None else min(self.low, *self.days)
            self.high = max(self.days) if self.high is None else max(self.high, *self.days)
            self.days, self.values = [], []

    def model(self, level: float):
        """A function from a day to forecast, lower and upper bound."""
        self._flush()
        found = solve(self.products, (self.high or 0) - (self.low or 0), self.seasons)
        p, z = len(found["means"]), z_score(level)
        inverse = np.array(found["inverse"]).reshape(p, p)

        def at(day: int) -> tuple[float | None, float | None, float | None]:
            if found["intercept"] is None:
                return None, None, None
            x = feature_matrix(np.array([day], float), self.seasons)[0]
            value = found["intercept"] + float(x @ found["coefficients"])
            off = x - found["means"]
            half = found["sigma"] * z * float(np.sqrt(1 + (1 + off @ inverse @ off) / max(found["n"], 1)))
            return value, value - half, value + half

        return at


class Forecast:
    """``forecast(input_data, timestamp_colname, target_colname, ...)``: the next days of each partition."""

    def __init__(self):
        self.sums, self.last = None, None

    @staticmethod
    def analyze(
        input_data: AnalyzeArgument, timestamp_colname: AnalyzeArgument, target_colname: AnalyzeArgument,
        series_colname: AnalyzeArgument | None = None, forecasting_periods: AnalyzeArgument | None = None,
        prediction_interval: AnalyzeArgument | None = None, seasons: AnalyzeArgument | None = None,
    ) -> AnalyzeResult:
        _checked(input_data, [timestamp_colname, target_colname])
        keys = _checked(input_data, [series_colname]) if series_colname else []
        _seasons(seasons.value if seasons else None)
        return AnalyzeResult(schema=StructType([*keys, StructField("ts", DateType()), *_BOUNDS]))

    def eval(self, input_data, timestamp_colname, target_colname, series_colname=None, forecasting_periods=1,
             prediction_interval=0.95, seasons=None):
        if self.sums is None:
            self.sums, self.level, self.periods = Sums(_seasons(seasons)), float(prediction_interval), int(forecasting_periods)
            self.keys = [input_data[c] for c in _names(series_colname)]
        ts, y = input_data[timestamp_colname], input_data[target_colname]
        if ts is None:
            return
        day = _day(ts)
        self.last = day if self.last is None else max(self.last, day)
        if y is not None:
            self.sums.add(day, float(y))

    def terminate(self):
        if self.last is None:
            return
        at = self.sums.model(self.level)
        for day in range(self.last + 1, self.last + self.periods + 1):
            yield *self.keys, dt.date.fromordinal(day + _FIRST), *at(day)


class DetectAnomalies:
    """``detect_anomalies(input_data, timestamp_colname, target_colname, since, ...)``: rows from a day on, flagged.

    The partition's rows have to come in the order of their times: ``PARTITION BY ... ORDER BY ...``.
    """

    def __init__(self):
        self.sums, self.at = None, None

    @staticmethod
    def analyze(
        input_data: AnalyzeArgument, timestamp_colname: AnalyzeArgument, target_colname: AnalyzeArgument, since: AnalyzeArgument,
        series_colname: AnalyzeArgument | None = None, prediction_interval: AnalyzeArgument | None = None,
        seasons: AnalyzeArgument | None = None,
    ) -> AnalyzeResult:
        _checked(input_data, [timestamp_colname, target_colname])
        keys = _checked(input_data, [series_colname]) if series_colname else []
        _seasons(seasons.value if seasons else None)
        dt.date.fromisoformat(since.value)
        return AnalyzeResult(schema=StructType([
            *keys, StructField("ts", DateType()), StructField("y", DoubleType()), *_BOUNDS, StructField("is_anomaly", BooleanType())]))

    def eval(self, input_data, timestamp_colname, target_colname, since, series_colname=None, prediction_interval=0.99, seasons=None):
        if self.sums is None:
            self.sums, self.since = Sums(_seasons(seasons)), _day(dt.date.fromisoformat(since))
        ts, y = input_data[timestamp_colname], input_data[target_colname]
        if ts is None:
            return
        day = _day(ts)
        if day < self.since:
            if self.at is not None:
                raise ValueError("rows are not in the order of their times: add ORDER BY to the table argument")
            if y is not None:
                self.sums.add(day, float(y))
            return
        if self.at is None:
            self.at = self.sums.model(float(prediction_interval))
        value, lower, upper = self.at(day)
        flag = None if y is None or value is None else not lower <= float(y) <= upper
        yield (*[input_data[c] for c in _names(series_colname)], dt.date.fromordinal(day + _FIRST),
               None if y is None else float(y), value, lower, upper, flag)


def register(spark: SparkSession) -> None:
    """Make ``forecast`` and ``detect_anomalies`` callable from this session's SQL."""
    spark.udtf.register("forecast", udtf(Forecast))
    spark.udtf.register("detect_anomalies", udtf(DetectAnomalies))
