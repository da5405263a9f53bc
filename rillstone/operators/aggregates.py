"""Grouped summaries, frequency tables, pivots and distribution tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.operators.joins import join_groups
from rillstone.operators.quantiles import exact_quantiles
from rillstone.session import stage


def pivot_max(df: DataFrame, keys: list[str | Column], kind: str, value: Column, columns: dict[str, str]) -> DataFrame:
    """One row per key, one column per kind holding its largest value.

    The kinds are given, so no extra pass looks for them, and partial results
    are combined before the shuffle.
    """
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(kind) == k, value)).alias(name) for k, name in columns.items()]
    )


def frequency(df: DataFrame, *cols: str | Column, name: str = "count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, column: str, n: int, name: str = "count") -> DataFrame:
    """The n most frequent values; equal counts are ordered by the value."""
    return frequency(df.filter(F.col(column).isNotNull()), column, name=name).orderBy(F.desc(name), column).limit(n)


def duplicates(df: DataFrame, keys: list[str], name: str = "cnt") -> DataFrame:
    return frequency(df, *keys, name=name).filter(F.col(name) > 1)


def count_all_columns(df: DataFrame, by: list[str]) -> DataFrame:
    """Non-null count of every other column per group."""
    return df.groupBy(*by).agg(*[F.count(c).alias(c) for c in df.columns if c not in by])


def cross_tab(df: DataFrame, row: str, column: str, values: list, prefix: str = "") -> DataFrame:
    """Counts of two keys with one column per value; empty cells are NULL."""
    counts = F.count(F.lit(1))
    cells = [
        F.nullif(F.count(F.when(F.col(column) == v, 1)), F.lit(0)).alias(f"{prefix}{v}") for v in values
    ]
    return df.groupBy(row).agg(counts.alias("_n"), *cells).drop("_n")


def numeric_columns(df: DataFrame, without: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without]


def group_means(df: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    columns = columns or numeric_columns(df, [by])
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns])


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns in long form, from one pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("left_col"), F.lit(b).alias("right_col"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ])
    return wide.select(F.inline(rows))


def mode(df: DataFrame, by: list[str], column: str, name: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest one on a tie.

    Counting per (group, value) first keeps the state of a group to one row per
    task, where the built-in aggregate holds all its distinct values.
    """
    counts = frequency(df.filter(F.col(column).isNotNull()), *by, column, name="_n")
    return counts.groupBy(*by).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(name))


def mode_distribution(df: DataFrame, by: str, column: str, name: str = "count") -> DataFrame:
    """How many groups have each value as their mode."""
    return frequency(mode(df, [by], column, name=column), column, name=name)


def unpivot(df: DataFrame, ids: list[str], columns: list[str], kind: str, value: str) -> DataFrame:
    return df.unpivot(ids, columns, kind, value)


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, a row per column (and group)."""
    by = by or []
    keys = [*by, "column"]
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(by, columns, "column", "value")
    basics = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, keys)
    joined = basics.alias("b").join(
        quartiles.alias("q"), [F.col(f"b.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys], "left"
    )
    return joined.select(
        *[F.col(f"b.{k}") for k in keys], "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and null share of every column, from one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f.name).alias("non_null"),
                 (1 - F.try_divide(F.col(f.name), F.col("_rows"))).alias("null_ratio"))
        for f in df.schema.fields
    ])
    return wide.select(F.inline(rows))


def column_means(df: DataFrame, columns: list[str], strip: str = "") -> DataFrame:
    """Mean of each column as a row, the label upper-cased and freed of a suffix."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], columns, "measure", "average")
    label = F.upper("measure")
    return means.withColumn("measure", F.replace(label, F.lit(strip), F.lit("")) if strip else label)


def group_total_means(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Mean over rows of the NULL-skipping row total of each group of columns."""
    totals = {
        name: sum([F.coalesce(F.col(c), F.lit(0.0)) for c in cols[1:]], F.coalesce(F.col(cols[0]), F.lit(0.0)))
        for name, cols in groups.items()
    }
    return df.agg(*[F.avg(t).alias(n) for n, t in totals.items()]).unpivot([], list(groups), "category", "average")


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    index = F.floor(F.try_divide((value - low) * bins, high - low))
    return F.least(F.greatest(F.coalesce(index, F.lit(0)), F.lit(0)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts in equal-width bins over the range of the whole column."""
    by = by or []
    rows = df.select(*by, F.col(column).cast("double").alias("_v")).filter("_v is not null")
    edges = rows.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).select(F.struct("_lo", "_hi").alias("e")).scalar()
    binned = rows.withColumn("_e", edges).withColumn("bin", _bin(F.col("_v"), F.col("_e._lo"), F.col("_e._hi"), bins))
    width = (F.col("_e._hi") - F.col("_e._lo")) / bins
    return (
        binned.groupBy(*by, "bin", "_e").agg(F.count(F.lit(1)).alias("count"))
        .select(*by, "bin", (F.col("_e._lo") + F.col("bin") * width).alias("bin_start"), "count")
    )


def histogram_2d(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts in a grid of equal-width bins over two columns."""
    rows = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    edges = rows.agg(
        F.struct(F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1")).alias("e")
    ).scalar()
    return (
        rows.withColumn("_e", edges)
        .groupBy(
            _bin(F.col("_x"), F.col("_e.x0"), F.col("_e.x1"), bins).alias("x_bin"),
            _bin(F.col("_y"), F.col("_e.y0"), F.col("_e.y1"), bins).alias("y_bin"),
        )
        .agg(F.count(F.lit(1)).alias("count"))
    )


def box_summary(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outlier count per group."""
    quartiles = stage(exact_quantiles(df, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]))
    value, iqr = F.col("_v"), F.col("q3") - F.col("q1")
    inside = value.between(F.col("q1") - iqr * 1.5, F.col("q3") + iqr * 1.5)
    rows = df.select(by, F.col(column).cast("double").alias("_v")).filter("_v is not null")
    return join_groups(rows, quartiles, [by]).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )


def trend(df: DataFrame, y: str, x: str, by: list[str] | None = None) -> DataFrame:
    """Least-squares line of y on x per group."""
    return df.groupBy(*(by or [])).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def share_of_stack(df: DataFrame, stack: list[str], value: str, name: str = "share") -> DataFrame:
    """Each row's part of the total of its stack; NULL where the total is zero.

    The totals are aggregated first and joined back, so a large stack is never
    sorted through one task.
    """
    totals = df.groupBy(*stack).agg(F.sum(value).alias("_total"))
    return join_groups(df, totals, stack, "left").withColumn(name, F.try_divide(F.col(value), F.col("_total"))).drop("_total")


def leaderboard(df: DataFrame, by: str, score: str, category: str) -> DataFrame:
    """Mean score and most frequent category per group."""
    scores = df.groupBy(by).agg(F.avg(score).alias(score))
    return join_groups(scores, mode(df, [by], category, name=category), [by], "left")


def ranked_extremes(df: DataFrame, metric: str, k: int, tie: list[str], label: str = "side") -> DataFrame:
    """The k largest and the k smallest rows by a metric; rows without it are left out."""
    rows = df.filter(F.col(metric).isNotNull())
    largest = rows.orderBy(F.desc(metric), *tie).limit(k).withColumn(label, F.lit("largest"))
    smallest = rows.orderBy(F.asc(metric), *tie).limit(k).withColumn(label, F.lit("smallest"))
    return largest.unionByName(smallest)


def change_from_previous(df: DataFrame, entity: str, order: list[str], value: str) -> DataFrame:
    """Previous row's value, difference and percent change per entity, over an aggregated table."""
    previous = F.lag(value).over(Window.partitionBy(entity).orderBy(*order))
    return (
        df.withColumn(f"{value}_prev", previous)
        .withColumn(f"{value}_change", F.col(value) - F.col(f"{value}_prev"))
        .withColumn(
            f"{value}_pct_change",
            F.bround(F.try_divide(F.col(f"{value}_change"), F.col(f"{value}_prev")) * 100, 1),
        )
    )
