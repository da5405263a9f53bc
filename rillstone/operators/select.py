"""Projections, row filters, samples and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions.columns import uniform


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep exactly the mapped columns, under their new names."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items()])


def rename_all(df: DataFrame, exceptions: dict[str, str] | None = None) -> DataFrame:
    """Upper-case every column name, except those given a name of their own."""
    exceptions = exceptions or {}
    return df.toDF(*[exceptions.get(c, c.upper()) for c in df.columns])


def numeric_and_text_columns(df: DataFrame, target: str) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the text columns, without the target."""
    fields = [f for f in df.schema.fields if f.name != target]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def any_null(df: DataFrame, subset: list[str] | None = None) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in subset or df.columns])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows left after a delete: a row whose predicate is NULL is not deleted."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def correct_value(df: DataFrame, key: Column, column: str, value) -> DataFrame:
    """Overwrite one column of the rows picked by ``key``."""
    return df.withColumn(column, F.when(key, F.lit(value)).otherwise(F.col(column)))


def bernoulli_sample(df: DataFrame, fraction: float, keys: list[str], seed: int = 0) -> DataFrame:
    """Keep each row with the given probability, decided by its key alone."""
    return df.filter(uniform(seed, *keys) < fraction)


def with_split(
    df: DataFrame, weights: dict[str, float], keys: list[str], seed: int = 0, name: str = "grp"
) -> DataFrame:
    """Label each row with one of the weighted groups.

    The label is a function of the key, so the groups are disjoint, and they
    stay the same however the table is laid out or re-read.
    """
    total = sum(weights.values())
    draw = uniform(seed, *keys)
    label, upper = None, 0.0
    *head, last = weights
    for group in head:
        upper += weights[group] / total
        hit = draw < upper
        label = F.when(hit, F.lit(group)) if label is None else label.when(hit, F.lit(group))
    return df.withColumn(name, F.lit(last) if label is None else label.otherwise(F.lit(last)))


def split(
    df: DataFrame, weights: dict[str, float], keys: list[str], seed: int = 0
) -> dict[str, DataFrame]:
    """One DataFrame per weighted group."""
    labelled = with_split(df, weights, keys, seed, name="_split")
    return {g: labelled.filter(F.col("_split") == g).drop("_split") for g in weights}


def distinct_sorted(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    order = F.col(column).desc() if descending else F.col(column)
    return df.select(column).dropna().distinct().orderBy(order)
