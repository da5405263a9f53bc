"""Synthetic tables whose every value is a function of a row key and a seed.

A key table decides how many rows there are; any task can be re-run and gives
the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.columns import normal, uniform, uniform_int

# Word lists for synthetic people.
FIRST_NAMES = ["Ada", "Bela", "Carl", "Dina", "Emil", "Fay", "Gus", "Hana", "Ivan", "Jane", "Kofi", "Lena"]
LAST_NAMES = ["Abel", "Brook", "Cole", "Drew", "Ember", "Frost", "Grove", "Hart", "Iver", "Jewel", "Keen", "Lark"]
STREETS = ["Oak Street", "Mill Lane", "Station Road", "Hill Avenue", "River Walk", "Park Way"]
CITIES = ["Ashford", "Bridgeton", "Clearwater", "Dunmore", "Eastvale", "Fairview", "Glenwood", "Harbor"]
STATES = ["Alabama", "Colorado", "Georgia", "Idaho", "Kansas", "Maine", "Nevada", "Oregon", "Texas", "Utah"]


def pick(values: list, seed: int | str, *keys: Column | str) -> Column:
    """One of the values, chosen by the row key."""
    index = uniform_int(seed, 0, len(values) - 1, *keys).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def letters(n: int, seed: int | str, *keys: Column | str) -> Column:
    """Random upper-case text of n letters."""
    return F.concat(*[F.chr((uniform_int(f"{seed}.{i}", 0, 25, *keys) + 65)) for i in range(n)])


def people(keys: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Name, address, city, state and mail address for every key."""
    first, last = pick(FIRST_NAMES, f"{seed}.first", key), pick(LAST_NAMES, f"{seed}.last", key)
    number = uniform_int(f"{seed}.number", 1, 999, key).cast("string")
    return keys.select(
        key, F.concat_ws(" ", first, last).alias("name"),
        F.concat_ws(" ", number, pick(STREETS, f"{seed}.street", key)).alias("address"),
        pick(CITIES, f"{seed}.city", key).alias("city"), pick(STATES, f"{seed}.state", key).alias("state"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.col(key).cast("string"), F.lit("@example.com")).alias("email"))


def interest_blocks(keys: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Three labelled blocks of uniform scores and ratings, a row of each per key."""
    # Class, label, score range, rating range of each block.
    blocks = [("not_interested", False, (0, 4), (0, 3)), ("add_to_wishlist", False, (4, 7), (3, 7)),
              ("purchase", True, (7, 10), (7, 10))]
    parts = [
        keys.select(
            key, uniform_int(f"{seed}.{name}.score", *score, key).cast("string").alias("user_interest_score"),
            uniform_int(f"{seed}.{name}.rating", *rating, key).alias("user_rating"),
            F.lit(label).alias("label"), F.lit(name).alias("class"))
        for name, label, score, rating in blocks
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def regression_table(keys: DataFrame, key: str, weights: list[float], noise: float = 0.1, categories: int = 0, seed: int = 0) -> DataFrame:
    """Standard normal features, their weighted sum plus noise, and two-letter categories."""
    xs = {f"x{i + 1}": normal(f"{seed}.x{i + 1}", key) for i in range(len(weights))}
    rows = keys.select(key, *[x.alias(n) for n, x in xs.items()])
    target = sum((F.col(f"x{i + 1}") * w for i, w in enumerate(weights)), normal(f"{seed}.noise", key) * noise)
    rows = rows.withColumn("y", target)
    return rows.withColumns({f"c{i + 1}": letters(2, f"{seed}.c{i + 1}", key) for i in range(categories)})


def classification_table(keys: DataFrame, key: str, features: int = 6, informative: int = 2, gap: float = 1.0, seed: int = 0) -> DataFrame:
    """Two classes whose informative features lie ``gap`` to either side of zero."""
    rows = keys.withColumn("y", uniform_int(f"{seed}.y", 0, 1, key).cast("int"))
    side = F.when(F.col("y") == 1, F.lit(gap)).otherwise(F.lit(-gap))
    return rows.select(key, *[
        (normal(f"{seed}.x{i + 1}", key) + (side if i < informative else F.lit(0.0))).alias(f"x{i + 1}")
        for i in range(features)], "y")


def hourly_readings(template: DataFrame, keys: list[str], base: str, start, end, noise: float = 0.15, seed: int = 0) -> DataFrame:
    """An hourly reading around the template's value for every key, from start to end.

    Each template row unfolds its own hours; no cross join is needed.
    """
    hours = F.sequence(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"), F.expr("interval 1 hour"))
    grid = template.withColumn("record_ts", F.explode(hours))
    factor = 1.0 + (uniform(seed, *keys, F.date_format("record_ts", "yyyy-MM-dd HH")) * 2.0 - 1.0) * noise
    return grid.withColumn("reading", F.greatest(F.round(F.col(base) * factor, 1), F.lit(0.0)))


def people_job(spark: SparkSession, rows: int, path: str, first_id: int = 0, seed: int = 0, mode: str = "append") -> str:
    """Write that many synthetic people; another range of ids gives other people."""
    people(spark.range(first_id, first_id + rows), "id", seed).write.mode(mode).parquet(path)
    return f"Inserted {rows} rows into {path}"
