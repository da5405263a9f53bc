"""Trend and seasons of any length for many series, from sums that one pass makes.

A season is a few harmonics of its period. All products of trend, harmonics and
value are summed per series; which seasons a series has is then decided from
these sums alone, by the Bayesian information criterion, without reading the
rows again. Intervals widen with the distance from the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.series import _join, day_number, z_score
from rillstone.session import stage

EPOCH = 10957.0  # the trend counts years from 2000-01-01, so that sums stay small


@dataclass(frozen=True)
class Season:
    name: str
    days: float
    harmonics: int


WEEK, MONTH, YEAR = Season("week", 7.0, 3), Season("month", 30.436875, 2), Season("year", 365.2425, 2)
KNOWN = {s.name: s for s in (WEEK, MONTH, YEAR)}


def _waves(seasons: tuple[Season, ...]) -> list[tuple[Season, int]]:
    return [(s, k) for s in seasons for k in range(1, s.harmonics + 1)]


def feature_columns(day: Column, seasons: tuple[Season, ...]) -> list[Column]:
    """Trend, then sine and cosine of each harmonic."""
    angle = [(day - EPOCH) * (2 * math.pi * k / s.days) for s, k in _waves(seasons)]
    return [(day - EPOCH) / YEAR.days, *[f(a) for a in angle for f in (F.sin, F.cos)]]


def feature_matrix(day: np.ndarray, seasons: tuple[Season, ...]) -> np.ndarray:
    """The same for an array of day numbers, one row per day."""
    angle = [(day - EPOCH) * (2 * math.pi * k / s.days) for s, k in _waves(seasons)]
    return np.column_stack([(day - EPOCH) / YEAR.days, *[f(a) for a in angle for f in (np.sin, np.cos)]])


def _members(seasons: tuple[Season, ...], chosen: tuple[Season, ...]) -> np.ndarray:
    """Positions of the features of the chosen seasons; the trend is always there."""
    owner = [None, *[s for s, _ in _waves(seasons) for _ in range(2)]]
    return np.array([i for i, s in enumerate(owner) if s is None or s in chosen])


def solve(products: np.ndarray, span: float, seasons: tuple[Season, ...]) -> dict:
    """The best model for summed products of (1, features, y).

    Every set of seasons that the span holds twice is tried; the criterion picks
    one. Features that do not vary, or repeat another, get the smallest solution.
    """
    n, p = products[0, 0], len(products) - 2
    none = {"n": int(n), "intercept": None, "coefficients": [0.0] * p, "means": [0.0] * p, "inverse": [0.0] * p * p,
            "sigma": 0.0, "seasons": []}
    if n < 1:
        return none
    mean = products[0, 1:] / n
    cov = products[1:, 1:] / n - np.outer(mean, mean)
    spread = max(cov[-1, -1], 0.0)
    known = [s for s in seasons if span >= 2 * s.days]
    best = None
    for size in range(len(known) + 1):
        for chosen in combinations(known, size):
            at = _members(seasons, chosen)
            if size and n <= len(at) + 2:
                continue
            inverse = np.linalg.pinv(cov[np.ix_(at, at)], rcond=1e-10, hermitian=True)
            beta = inverse @ cov[at, -1]
            left = max(spread - beta @ cov[at, -1], 0.0)
            score = n * math.log(max(left, 1e-12 * spread, 1e-300)) + (len(at) + 1) * math.log(n)
            if best is None or score < best[0]:
                best = (score, chosen, at, inverse, beta, left)
    _, chosen, at, inverse, beta, left = best
    coefficients, full = np.zeros(p), np.zeros((p, p))
    coefficients[at], full[np.ix_(at, at)] = beta, inverse
    return none | {
        "intercept": float(mean[-1] - coefficients @ mean[:-1]), "coefficients": coefficients.tolist(),
        "means": mean[:-1].tolist(), "inverse": full.ravel().tolist(),
        "sigma": math.sqrt(n * left / max(n - len(at) - 1, 1)), "seasons": [s.name for s in chosen]}


def fit(df: DataFrame, keys: list[str], ts: str, y: str, seasons: tuple[Season, ...] = (WEEK, MONTH, YEAR)) -> DataFrame:
    """One row per series: its seasons, coefficients, deviation, and what its interval needs.

    Rows of one day are summed first, so a series sends a row per day and task.
    Rows without a time or value do not count; a series without any has no intercept.
    """
    value = F.when(F.to_date(ts).isNotNull(), F.col(y).cast("double"))
    days = df.select(*keys, F.to_date(ts).alias("_d"), value.alias("_y")).groupBy(*keys, "_d").agg(
        F.count("_y").alias("_n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("_s"),
        F.coalesce(F.sum(F.col("_y") * F.col("_y")), F.lit(0.0)).alias("_ss"))
    features = feature_columns(day_number("_d"), seasons)
    p = len(features)
    rows = days.select(*keys, "_d", "_n", "_s", "_ss", *[f.alias(f"_x{i}") for i, f in enumerate(features)])
    x = [F.col(f"_x{i}") for i in range(p)]
    n = F.col("_n")
    pairs = [n, *[n * a for a in x], F.col("_s")]
    pairs += [c for i, a in enumerate(x) for c in [*[n * a * b for b in x[i:]], a * F.col("_s")]] + [F.col("_ss")]
    held = F.when(n > 0, F.col("_d"))
    sums = rows.groupBy(*keys).agg(
        F.array(*[F.coalesce(F.sum(c), F.lit(0.0)).cast("double") for c in pairs]).alias("products"),
        F.coalesce(F.date_diff(F.max(held), F.min(held)), F.lit(0)).alias("span"), F.max("_d").alias("last_ts"))
    upper = np.triu_indices(p + 2)

    def models(batches):
        for pdf in batches:
            found = []
            for products, span in zip(pdf["products"], pdf["span"], strict=True):
                square = np.zeros((p + 2, p + 2))
                square[upper] = products
                found.append(solve(square + np.triu(square, 1).T, span, seasons))
            if found:
                yield pd.concat([pdf[[*keys, "last_ts"]], pd.DataFrame(found)], axis=1)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema.fields if f.name in keys]
    schema = ", ".join([*kinds, "last_ts date", "n bigint", "intercept double", "coefficients array<double>", "means array<double>",
                        "inverse array<double>", "sigma double", "seasons array<string>"])
    return stage(sums.mapInPandas(models, schema))


def with_forecast(rows: DataFrame, day: Column, seasons: tuple[Season, ...], level: float) -> DataFrame:
    """Rows joined with their model, with its value and interval for a day."""
    p = 1 + 2 * len(_waves(seasons))
    rows = rows.withColumn("_f", F.array(*feature_columns(day, seasons)))
    rows = rows.withColumn("_o", F.zip_with("_f", "means", lambda a, b: a - b))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    product = lambda a, b: total(F.zip_with(a, b, lambda u, v: u * v))
    value = F.col("intercept") + product(F.col("_f"), F.col("coefficients"))
    # the further from the mean of the data, the less is known about the line itself
    apart = total(F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.get("_o", i) * product(
        F.slice("inverse", i * p + 1, F.lit(p)), F.col("_o"))))
    half = F.col("sigma") * z_score(level) * F.sqrt(1 + (1 + apart) / F.greatest(F.col("n"), F.lit(1)))
    return rows.withColumn("forecast", value).withColumn("lower_bound", value - half).withColumn(
        "upper_bound", value + half).drop("_f", "_o")


def forecast(
    model: DataFrame, keys: list[str], periods: int, seasons: tuple[Season, ...] = (WEEK, MONTH, YEAR), level: float = 0.95,
) -> DataFrame:
    """The next ``periods`` days of every series, with intervals that widen."""
    ahead = model.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    ahead = ahead.withColumn("ts", F.date_add("last_ts", F.col("step")))
    return with_forecast(ahead, day_number("ts"), seasons, level).select(*keys, "ts", "forecast", "lower_bound", "upper_bound")


def detect_anomalies(
    df: DataFrame, keys: list[str], ts: str, y: str, cut, seasons: tuple[Season, ...] = (WEEK, MONTH, YEAR), level: float = 0.99,
) -> DataFrame:
    """Rows from ``cut`` on, flagged when outside the interval of a model fitted before it."""
    cut = F.lit(cut).cast(df.schema[ts].dataType)
    model = fit(df.filter(F.col(ts) < cut), keys, ts, y, seasons).drop("last_ts")
    scored = with_forecast(_join(df.filter(F.col(ts) >= cut), model, keys), day_number(ts), seasons, level)
    outside = ~F.col(y).between(F.col("lower_bound"), F.col("upper_bound"))
    return scored.select(*df.columns, "forecast", "lower_bound", "upper_bound", outside.alias("is_anomaly"))
