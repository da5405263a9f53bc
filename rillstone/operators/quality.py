"""Data-quality checks, each reporting how many rows (or groups) break it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.joins import orphans
from rillstone.operators.quantiles import exact_quantiles
from rillstone.operators.select import any_null


@dataclass(frozen=True)
class Check:
    """A named condition; ``failures`` is an aggregate that is 0 when it holds."""

    name: str
    column: str
    failures: Column
    severity: str = "error"


def rows_where(name: str, column: str, broken: Column, severity: str = "error") -> Check:
    return Check(name, column, F.count_if(F.coalesce(broken, F.lit(False))), severity)


def not_null(column: str, severity: str = "error") -> Check:
    return rows_where("not_null", column, F.col(column).isNull(), severity)


def positive_value(column: str, severity: str = "error") -> Check:
    """Fails below 1; NULL passes."""
    return rows_where("positive_value", column, F.col(column) < 1, severity)


def accepted_values(column: str, values: list, severity: str = "error") -> Check:
    return rows_where("accepted_values", column, ~F.col(column).isin(values), severity)


def matches(column: str, pattern: str, severity: str = "error") -> Check:
    return rows_where("matches_regex", column, ~F.col(column).rlike(pattern), severity)


def no_nulls(df: DataFrame, severity: str = "error") -> Check:
    """Rows with a NULL in any column."""
    return rows_where("no_nulls", "*", any_null(df), severity)


def max_at_most(column: str, limit: float, severity: str = "error") -> Check:
    return Check("max_at_most", column, F.coalesce((F.max(column) > limit).cast("long"), F.lit(0)), severity)


def distinct_count_equals(column: str, n: int, severity: str = "error") -> Check:
    return Check("distinct_count", column, (F.count_distinct(column) != n).cast("long"), severity)


def _status(severity: str) -> Column:
    return F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("warn" if severity == "warn" else "fail"))


def report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks over one table from a single pass, one row per check."""
    wide = df.agg(*[c.failures.cast("long").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
                 F.col(f"c{i}").alias("failures"), F.lit(c.severity).alias("severity"))
        for i, c in enumerate(checks)
    ])
    status = F.when(F.col("failures") == 0, F.lit("pass")).when(F.col("severity") == "warn", F.lit("warn"))
    return wide.select(F.inline(rows)).withColumn("status", status.otherwise(F.lit("fail")))


def _one(name: str, column: str, df: DataFrame, failures: Column, severity: str = "error") -> DataFrame:
    return df.agg(failures.cast("long").alias("failures")).select(
        F.lit(name).alias("check"), F.lit(column).alias("column"), "failures",
        F.lit(severity).alias("severity"), _status(severity).alias("status"),
    )


def unique(df: DataFrame, keys: list[str], severity: str = "error") -> DataFrame:
    """Number of keys that occur more than once.

    For one column NULLs are not compared; in a combination NULL is a value like any other.
    """
    rows = df.dropna(subset=keys) if len(keys) == 1 else df
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _one("unique", ",".join(keys), counts, F.count_if(F.col("n") > 1), severity)


def relationship(child: DataFrame, key: str, parent: DataFrame, parent_key: str, severity: str = "error") -> DataFrame:
    lost = orphans(child.select(key), key, parent, parent_key)
    return _one("relationship", key, lost, F.count(F.lit(1)), severity)


def same_row_count(df: DataFrame, other: DataFrame, severity: str = "error") -> DataFrame:
    """Difference in the number of rows."""
    theirs = other.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _one("same_row_count", "*", df, F.abs(F.count(F.lit(1)) - theirs), severity)


def quantile_between(df: DataFrame, column: str, q: float, low: float, high: float, severity: str = "error") -> DataFrame:
    found = exact_quantiles(df, column, {"q": q})
    return _one(f"quantile_{q:g}", column, found, F.count_if(~F.col("q").between(low, high)), severity)


def freshness(df: DataFrame, column: str, as_of, warn_hours: float = 1, error_hours: float = 24) -> DataFrame:
    """Age of the newest row in hours and its status; a table without rows is in error."""
    kind = df.schema[column].dataType
    newest = df.agg(F.max(column).alias("newest"))
    age = F.timestamp_diff("MICROSECOND", F.col("newest"), F.lit(as_of).cast(kind)) / 3.6e9
    status = F.when(F.col("age_hours") <= warn_hours, F.lit("pass")).when(F.col("age_hours") <= error_hours, F.lit("warn"))
    return newest.withColumn("age_hours", age).withColumn("status", status.otherwise(F.lit("error")))


def column_type_is(df: DataFrame, column: str, expected: str) -> bool:
    """Whether a column has a type such as ``double``, ``decimal(10,2)`` or the family ``number``."""
    actual = df.schema[column].dataType.simpleString()
    if expected == "number":
        return actual.split("(")[0] in {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"}
    return actual == expected


def before_event(child: DataFrame, parent: DataFrame, key: str, created: str, happened: str) -> DataFrame:
    """Child events that happened no later than their parent was created."""
    return child.join(parent, key).filter(F.col(created) >= F.col(happened))
