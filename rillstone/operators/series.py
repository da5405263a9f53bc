"""Forecasts, intervals and anomaly flags for many time series at once.

Models are fitted from sums that tasks combine before the shuffle, so the
length of a series is no limit; only one row per series is ever solved in one
place.
"""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.evaluate import regression_metrics
from rillstone.operators.joins import join_groups
from rillstone.session import stage


def z_score(level: float) -> float:
    """Half width, in standard deviations, of a central interval with the given probability."""
    return NormalDist().inv_cdf(0.5 + level / 2)


def day_number(ts: Column | str) -> Column:
    return F.unix_date(F.to_date(ts)).cast("double")


def _interval(df: DataFrame, level: float) -> DataFrame:
    half = F.col("sigma") * z_score(level)
    return df.withColumn("lower_bound", F.col("forecast") - half).withColumn("upper_bound", F.col("forecast") + half)


# ---------------------------------------------------------------- trend, optionally with a weekly season

def fit_trend(df: DataFrame, keys: list[str], ts: str, y: str, weekly: bool = False) -> DataFrame:
    """Least-squares line per series, with the deviation of its residuals.

    ``weekly`` adds the mean residual of each weekday, as a seven-element array.
    """
    t = day_number(ts)
    line = df.groupBy(*keys).agg(
        F.avg(y).alias("_level"), F.regr_count(F.col(y), t).alias("n"), F.max(ts).alias("last_ts"),
        F.regr_slope(F.col(y), t).alias("slope"), F.regr_intercept(F.col(y), t).alias("intercept"),
        (F.regr_syy(F.col(y), t) - F.coalesce(F.regr_slope(F.col(y), t), F.lit(0.0)) * F.regr_sxy(F.col(y), t)).alias("sse"),
    ).withColumns({
        # a single point has no slope: its level is carried on
        "slope": F.coalesce("slope", F.lit(0.0)),
        "sigma": F.sqrt(F.greatest(F.try_divide(F.col("sse"), F.col("n") - 2), F.lit(0.0))),
    })
    line = line.withColumn("intercept", F.coalesce("intercept", "_level")).drop("_level", "sse")
    line = stage(line)  # read again by every join of rows with their model
    if not weekly:
        return line
    residual = _join(df, line, keys).withColumn("_e", F.col(y) - F.col("intercept") - F.col("slope") * t)
    days = residual.groupBy(*keys).agg(*[
        F.avg(F.when(F.weekday(ts) == d, F.col("_e"))).alias(f"d{d}") for d in range(7)],
        F.var_pop("_e").alias("_all"), F.count("_e").alias("_m"),
        *[F.count(F.when(F.weekday(ts) == d, F.col("_e"))).alias(f"m{d}") for d in range(7)])
    season = F.array(*[F.coalesce(F.col(f"d{d}"), F.lit(0.0)) for d in range(7)])
    explained = reduce(lambda a, b: a + b, [
        F.coalesce(F.col(f"d{d}") * F.col(f"d{d}") * F.col(f"m{d}"), F.lit(0.0)) for d in range(7)])
    left = F.greatest(F.col("_all") * F.col("_m") - explained, F.lit(0.0))
    days = days.select(*keys, season.alias("season"),
                       F.sqrt(F.try_divide(left, F.greatest(F.col("_m") - 8, F.lit(1)))).alias("sigma"))
    return stage(_join(line.drop("sigma"), days, keys))


def fit_trend_robust(df: DataFrame, keys: list[str], ts: str, y: str, rounds: int = 6) -> DataFrame:
    """A line per series that outliers do not move: (keys, n, last_ts, slope, intercept, sigma).

    A fixed number of reweighted fits, each from sums: rows far from the last line,
    measured by the median of all distances, count less (Huber's weights), later
    not at all (Tukey's). The deviation is that of the rows within four of the
    last scale. Medians come from a sketch, so no series is held in one place.
    """
    t, v = day_number(ts), F.col(y).cast("double")
    last = df.groupBy(*keys).agg(F.max(ts).alias("last_ts"))
    rows = stage(df.select(*keys, (t - 10957.0).alias("_t"), v.alias("_v")).filter("_t is not null and _v is not null"))
    weighed, model = rows.withColumn("_w", F.lit(1.0)), None
    e = F.abs(F.col("_v") - F.col("intercept") - F.col("slope") * F.col("_t"))
    for k in range(rounds):
        model = stage(_weighted_line(weighed, keys))
        apart = _join(rows, model.select(*keys, "slope", "intercept"), keys).withColumn("_e", e)
        # the least scale stands for series that lie on their line
        scale = F.greatest(1.4826 * F.percentile_approx("_e", 0.5, 10_000), F.lit(1e-9))
        scaled = _join(apart, stage(apart.groupBy(*keys).agg(scale.alias("_s"))), keys)
        u = F.col("_e") / F.col("_s")
        huber = F.least(F.lit(1.0), 1.345 / F.greatest(u, F.lit(1e-9)))
        tukey = F.when(u < 4.685, F.pow(1 - F.pow(u / 4.685, 2), 2)).otherwise(0.0)
        weighed = scaled.withColumn("_w", huber if k < rounds // 2 else tukey).select(*keys, "_t", "_v", "_w", u.alias("_u"))
    line = _weighted_line(weighed.withColumn("_w", (F.col("_u") <= 4).cast("double")), keys)
    # back from days since 2000 to day numbers
    line = line.withColumn("intercept", F.col("intercept") - 10957.0 * F.col("slope"))
    return stage(_join(line, last, keys))


def _weighted_line(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted least squares of ``_v`` on ``_t`` with weights ``_w``: (keys, n, slope, intercept, sigma)."""
    w, t, v = F.col("_w"), F.col("_t"), F.col("_v")
    sums = rows.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in {
        "_0": w, "_1": w * t, "_2": w * t * t, "_y": w * v, "_ty": w * t * v, "_yy": w * v * v}.items()])
    n = F.col("_0")
    stt, sty = F.col("_2") - F.col("_1") * F.col("_1") / n, F.col("_ty") - F.col("_1") * F.col("_y") / n
    sums = sums.filter("_0 > 0").withColumns({
        "slope": F.when(stt > 1e-9 * n, sty / stt).otherwise(0.0), "_syy": F.col("_yy") - F.col("_y") * F.col("_y") / n, "_sty": sty})
    sse = F.greatest(F.col("_syy") - F.col("slope") * F.col("_sty"), F.lit(0.0))
    return sums.select(*keys, F.round(n).cast("long").alias("n"), "slope", ((F.col("_y") - F.col("slope") * F.col("_1")) / n).alias("intercept"),
                       F.sqrt(F.coalesce(F.when(n > 2, sse / (n - 2)), F.lit(0.0))).alias("sigma"))


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return join_groups(left, right, keys)
    # a single series: the other side is one aggregated row
    return left.withColumn("_one", right.select(F.struct("*")).scalar()).select(*left.columns, "_one.*")


def _at(day: Column, ts: Column, weekly: bool) -> Column:
    value = F.col("intercept") + F.col("slope") * day
    return value + F.try_element_at("season", F.weekday(ts) + 1) if weekly else value


def forecast(model: DataFrame, keys: list[str], periods: int, level: float = 0.95) -> DataFrame:
    """The next ``periods`` days of every series with their interval."""
    weekly = "season" in model.columns
    ahead = model.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    ts = F.date_add(F.to_date("last_ts"), F.col("step"))
    rows = ahead.withColumn("ts", ts).withColumn("forecast", _at(day_number("ts"), F.col("ts"), weekly))
    return _interval(rows, level).select(*keys, "ts", "forecast", "lower_bound", "upper_bound")


def fitted(model: DataFrame, df: DataFrame, keys: list[str], ts: str, level: float = 0.95) -> DataFrame:
    """Rows of a table with the model's value and interval at their own time."""
    weekly = "season" in model.columns
    rows = _join(df, model.select(*keys, "slope", "intercept", "sigma", *(["season"] if weekly else [])), keys)
    rows = rows.withColumn("forecast", _at(day_number(ts), F.col(ts), weekly))
    return _interval(rows, level).drop("slope", "intercept", "sigma", "season")


def actual_and_forecast(actual: DataFrame, predicted: DataFrame, keys: list[str], ts: str, y: str) -> DataFrame:
    """History and forecast under each other, the other side's columns empty."""
    history = actual.select(*keys, F.to_date(ts).alias("ts"), F.col(y).alias("actual"))
    return history.unionByName(predicted, allowMissingColumns=True)


def holdout_metrics(df: DataFrame, keys: list[str], ts: str, y: str, cut, weekly: bool = False) -> DataFrame:
    """Errors per series on the rows from ``cut`` on, of a model fitted before it."""
    before, after = df.filter(F.col(ts) < cut), df.filter(F.col(ts) >= cut)
    scored = fitted(fit_trend(before, keys, ts, y, weekly), after, keys, ts)
    return regression_metrics(scored, y, "forecast", keys).select(*keys, "n", "mae", "mse", "mape")


def detect_anomalies(
    df: DataFrame, keys: list[str], ts: str, y: str, cut, level: float = 0.99, weekly: bool = False, robust: bool = False,
) -> DataFrame:
    """Rows from ``cut`` on, flagged when outside the interval of a model fitted before it.

    With ``robust`` (a line only) anomalies before the cut neither move the line nor widen its interval.
    """
    if weekly and robust:
        raise ValueError("the robust line has no weekly season")
    cut = F.lit(cut).cast(df.schema[ts].dataType)
    before = df.filter(F.col(ts) < cut)
    model = fit_trend_robust(before, keys, ts, y) if robust else fit_trend(before, keys, ts, y, weekly)
    scored = fitted(model, df.filter(F.col(ts) >= cut), keys, ts, level)
    outside = ~F.col(y).between(F.col("lower_bound"), F.col("upper_bound"))
    return scored.withColumn("is_anomaly", outside)


def deviation_flags(df: DataFrame, keys: list[str], ts: str, y: str, cut, z: float = 3.0) -> DataFrame:
    """Rows from ``cut`` on, flagged when further than z deviations from the mean before it."""
    cut = F.lit(cut).cast(df.schema[ts].dataType)
    base = df.filter(F.col(ts) < cut).groupBy(*keys).agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"))
    rows = _join(df.filter(F.col(ts) >= cut), stage(base), keys)
    return rows.withColumn("is_anomaly", F.abs(F.col(y) - F.col("mean")) > F.col("std") * z).drop("mean", "std")


# ---------------------------------------------------------------- regression on further features

def fit_linear(df: DataFrame, keys: list[str], features: dict[str, Column], y: str) -> DataFrame:
    """Least squares per series on any features: (keys, n, intercept, coefficients, sigma).

    Spark sums the covariances; a task then solves one small system per series.
    """
    names = list(features)
    rows = df.select(*keys, F.col(y).cast("double").alias("_y"), *[features[f].cast("double").alias(f"_x{i}") for i, f in enumerate(names)]).dropna(
        subset=["_y", *[f"_x{i}" for i in range(len(names))]])
    p = len(names)
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("my"), F.var_pop("_y").alias("vy"),
        F.array(*[F.avg(f"_x{i}") for i in range(p)]).alias("mx"),
        F.array(*[F.covar_pop(f"_x{i}", f"_x{j}") for i in range(p) for j in range(p)]).alias("cxx"),
        F.array(*[F.covar_pop(f"_x{i}", "_y") for i in range(p)]).alias("cxy"))
    key_fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema.fields if f.name in keys)
    schema = (key_fields + ", " if key_fields else "") + "n bigint, intercept double, coefficients array<double>, sigma double"

    def solve(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            cxx = np.stack(pdf["cxx"].to_numpy()).reshape(-1, p, p)
            cxy, mx = np.stack(pdf["cxy"].to_numpy()), np.stack(pdf["mx"].to_numpy())
            # features that do not vary, or repeat another, get the smallest solution
            beta = np.einsum("kij,kj->ki", np.linalg.pinv(cxx, rcond=1e-10, hermitian=True), cxy)
            n = pdf["n"].to_numpy()
            sse = n * np.maximum(pdf["vy"].to_numpy() - (beta * cxy).sum(axis=1), 0.0)
            out = pdf[[*keys, "n"]].copy()
            out["intercept"] = pdf["my"].to_numpy() - (beta * mx).sum(axis=1)
            out["coefficients"] = list(beta)
            out["sigma"] = np.sqrt(sse / np.maximum(n - p - 1, 1))
            yield out

    return stage(sums.mapInPandas(solve, schema))


def predict_linear(model: DataFrame, df: DataFrame, keys: list[str], features: dict[str, Column], level: float = 0.95) -> DataFrame:
    """Forecast and interval for rows that supply the features' values."""
    rows = _join(df, model.select(*keys, "intercept", "coefficients", "sigma"), keys)
    value = F.col("intercept")
    for i, f in enumerate(features.values()):
        value = value + F.try_element_at("coefficients", F.lit(i + 1)) * f.cast("double")
    return _interval(rows.withColumn("forecast", value), level).drop("intercept", "coefficients", "sigma")
