"""Imputers, scalers and encoders.

Statistics reach the rows as scalar subqueries or as joins of small aggregated
tables, so fitting is one aggregate and transforming is a projection.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.aggregates import mode
from rillstone.operators.joins import join_groups
from rillstone.operators.numbering import number_rows
from rillstone.operators.quantiles import exact_quantiles
from rillstone.session import stage

# ---------------------------------------------------------------- imputers

def impute_constant_by_group(df: DataFrame, column: str, group: str, constants: dict) -> DataFrame:
    """Fill with a given constant per group value; other groups stay NULL."""
    pairs = [F.lit(x) for item in constants.items() for x in item]
    return df.withColumn(column, F.coalesce(F.col(column), F.try_element_at(F.create_map(*pairs), F.col(group))))


def impute_median(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Fill with the exact median of the table, or of the row's group."""
    out = df
    for c in columns:
        medians = exact_quantiles(df, c, {"_median": 0.5}, by)
        if by:
            out = join_groups(out, stage(medians), by, "left")
        else:
            out = out.withColumn("_median", medians.scalar())
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col("_median"))).drop("_median")
    return out


def impute_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill with the most frequent value, the smallest one on a tie."""
    fills = {c: F.coalesce(F.col(c), mode(df, [], c).scalar()) for c in columns}
    return df.withColumns(fills)


# ---------------------------------------------------------------- scalers

def _statistics(df: DataFrame, aggregates: list[Column]) -> Column:
    return df.agg(F.struct(*aggregates).alias("s")).scalar()


def standard_scale(df: DataFrame, columns: list[str], suffix: str = "_z", fitted_on: DataFrame | None = None) -> DataFrame:
    """Centred values in population standard deviations; a constant column becomes 0."""
    stats = _statistics(fitted_on or df, [
        f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))])
    rows = df.withColumn("_s", stats)
    scaled = {
        f"{c}{suffix}": F.when(F.col(f"_s.s{i}") == 0, F.col(c) * 0.0)
        .otherwise(F.try_divide(F.col(c) - F.col(f"_s.m{i}"), F.col(f"_s.s{i}")))
        for i, c in enumerate(columns)
    }
    return rows.withColumns(scaled).drop("_s")


def min_max_scale(df: DataFrame, columns: list[str], suffix: str = "_norm", fitted_on: DataFrame | None = None) -> DataFrame:
    """Values scaled to 0..1; a constant column becomes 0."""
    stats = _statistics(fitted_on or df, [
        f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    rows = df.withColumn("_s", stats)
    scaled = {}
    for i, c in enumerate(columns):
        low, high = F.col(f"_s.lo{i}"), F.col(f"_s.hi{i}")
        scaled[f"{c}{suffix}"] = F.when(high == low, F.col(c) * 0.0).otherwise(F.try_divide(F.col(c) - low, high - low))
    return rows.withColumns(scaled).drop("_s")


# ---------------------------------------------------------------- encoders

def categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values with their zero-based code, numbered range by range.

    The table is stored, so the optimizer knows its size and broadcasts it only
    where that is small.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return stage(number_rows(values, [column], "_code", start=0))


def ordinal_encode(df: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Code of each value in the sorted list of the column's values; NULL stays NULL."""
    out = df
    for c in columns:
        codes = categories(df, c).select(c, F.col("_code").cast("double").alias(f"{c}{suffix}"))
        out = out.join(codes, c, "left")
    return out


def one_hot_vector(df: DataFrame, column: str, name: str, codes: DataFrame | None = None, drop_first: bool = False) -> DataFrame:
    """One sparse 0/1 vector in place of a column per value, for any number of values.

    ``codes`` is a fitted ``categories`` table; NULL and unseen values give a vector of zeros.
    """
    codes = categories(df, column) if codes is None else codes
    size = codes.count()
    first = int(drop_first)
    place = F.col("_code").cast("int") - first
    rows = df.join(codes, column, "left").withColumn(
        "_code", F.when(place >= 0, place.cast("double")).otherwise(F.lit(float(size - first))))
    return _one_hot_model(size - first, name).transform(rows).drop("_code").select(*df.columns, name)


def _one_hot_model(size: int, name: str) -> OneHotEncoderModel:
    # the category after the last one stands for no value; it is the one dropped
    spark = SparkSession.active()
    last = spark.range(1).select(F.lit(float(size)).alias("_code"))
    return OneHotEncoder(inputCol="_code", outputCol=name, dropLast=True).fit(last)


def fitted_values(df: DataFrame, column: str, limit: int = 1000) -> list:
    """Distinct values for one-hot columns, sorted; refuses a column with too many (see ``one_hot_vector``)."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values; one column per value is not feasible")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, column: str, values: list, drop_first: bool = False, prefix: str | None = None) -> DataFrame:
    """A 0/1 column per fitted value; other values give zeros everywhere."""
    prefix = column if prefix is None else prefix
    kept = values[1:] if drop_first else values
    return df.withColumns({
        f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in kept
    })


def dummies(df: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """One-hot columns without the first value, replacing the column."""
    values = fitted_values(df, column) if values is None else values
    return one_hot(df, column, values, drop_first=True).drop(column)
