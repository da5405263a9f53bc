"""Join shapes that recur in the pipelines.

No broadcast hints are given: the optimizer broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``, which keeps
working when a dimension grows. Aggregated sides are staged first, so that
their size is known before a large side is shuffled. Hot keys on the large side of a shuffled join
are split at run time by ``spark.sql.adaptive.skewJoin``; ``salted_join`` is
for joins whose plan gives the optimizer no room to do that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.session import stage


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with what was aggregated for their group; NULL is a group like any other."""
    theirs = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(theirs, same, how).drop(*[f"_right_{k}" for k in keys])


def lookup_table(df: DataFrame, column: str, table: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Value of ``column`` in a two-column table of any size; unknown keys give NULL."""
    known = table.select(F.col(key).alias("_key"), F.col(value).alias(name)).filter("_key is not null")
    return df.join(known, F.col(column) == F.col("_key"), "left").drop("_key")


def new_rows(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key the target does not hold yet.

    A NULL key matches nothing, so such rows are always new; ``NOT IN`` would
    instead return no rows at all once the target holds a NULL.
    """
    return incoming.join(existing.select(*keys), keys, "left_anti").select(*incoming.columns)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a key that no parent row has; NULL keys are not orphans."""
    parents = parent.select(F.col(parent_key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti")


def flag_day_after(
    df: DataFrame, ts: str, days: DataFrame, day: str, hit: str, miss: str, flag: str, shift: int = 1
) -> DataFrame:
    """Label rows whose date falls ``shift`` days after a listed calendar date."""
    listed = days.select(F.date_add(F.col(day), shift).alias("_on")).filter("_on is not null").distinct()
    listed = stage(listed.withColumn("_hit", F.lit(True)))
    joined = df.withColumn("_on", F.to_date(ts)).join(listed, "_on", "left")
    return joined.withColumn(flag, F.when(F.col("_hit"), F.lit(hit)).otherwise(F.lit(miss))).drop("_on", "_hit")


def star(fact: DataFrame, *dims: tuple[DataFrame, str, str], how: str = "inner") -> DataFrame:
    """Join a fact to each (dimension, fact key, dimension key)."""
    out = fact
    for dim, fact_key, dim_key in dims:
        out = out.join(dim, out[fact_key] == dim[dim_key], how)
    return out


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys holding at least ``share`` of the rows: at most ``1 / share`` values."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return [r[0] for r in counts.filter(F.col("count") >= total * share).select(key).collect()]


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", salts: int = 32,
    share: float = 0.01, row_key: Column | None = None,
) -> DataFrame:
    """Inner or left join that spreads the hot keys of ``left`` over ``salts`` tasks.

    Only hot keys are salted; only their right-hand rows are copied. The salt
    comes from ``row_key``, which tells rows apart, or from the row's place in a
    stored copy, so a retried task assigns the same one and equal rows part.
    Rows without a key match nothing and are spread as well.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"cannot salt a {how} join")
    hot = hot_keys(left, key, share)
    if not hot:
        return left.join(right, key, how)
    if row_key is None:
        left = stage(left).withColumn("_place", F.monotonically_increasing_id())
        row_key = F.col("_place")
    spread = F.pmod(F.xxhash64(row_key), F.lit(salts)).cast("int")
    split = F.col(key).isin(hot) | F.col(key).isNull()
    left = left.withColumn("_salt", F.when(split, spread).otherwise(F.lit(0))).drop("_place")
    copies = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], how).drop("_salt")
