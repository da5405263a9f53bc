"""Exact quantiles that do not gather a whole group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.joins import join_groups
from rillstone.session import stage


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None, accuracy: int = 10_000,
) -> DataFrame:
    """Interpolated quantiles of ``value`` per group, one column per entry of ``probs``.

    The built-in ``percentile`` keeps every distinct value of a group in the
    memory of one task. Here each quantile is bracketed with a sketch, rows
    outside the bracket are merely counted, and the exact order statistics are
    read from the values left inside it, a share of ``8 / accuracy`` of the
    group. NULL is a group like any other.
    """
    by = by or []
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    # The bracket reaches `margin` to both sides of the sketch's own error (1 / accuracy).
    margin = 4.0 / accuracy
    points = [min(1.0, max(0.0, p + d)) for p in probs.values() for d in (-margin, margin)]

    # in a group this small the margin is less than a few rows: take all of its values
    tiny = F.col("_n") * margin < 4

    # rows of no group at all still need a key to join on
    keys = by or ["_all"]
    if not by:
        rows = rows.withColumn("_all", F.lit(0))
    brackets = stage(
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
            F.percentile_approx("_v", points, accuracy).alias("_q"),
        )
        .withColumn("_p", F.explode(F.array(*[
            F.struct(
                F.lit(name).alias("name"),
                (F.lit(p) * (F.col("_n") - 1)).alias("pos"),
                F.when(tiny | F.lit(points[2 * i] <= 0), F.col("_min")).otherwise(F.col("_q")[2 * i]).alias("lo"),
                F.when(tiny | F.lit(points[2 * i + 1] >= 1), F.col("_max")).otherwise(F.col("_q")[2 * i + 1]).alias("hi"),
            )
            for i, (name, p) in enumerate(probs.items())
        ])))
        .select(*keys, "_p.*")
    )

    # One row per bracket for everything below it, one per distinct value inside it.
    inside = F.when(F.col("_v") >= F.col("lo"), F.col("_v"))
    cells = (
        join_groups(rows, brackets, keys)
        .filter(F.col("_v") <= F.col("hi"))
        .groupBy(*keys, "name", "pos", inside.alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = Window.partitionBy(*keys, "name").orderBy(F.col("_cell").asc_nulls_first())
    ranked = cells.withColumn("_end", F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(rank):
        hit = F.col("_cell").isNotNull() & (F.col("_start") <= rank) & (rank < F.col("_end"))
        return F.max(F.when(hit, F.col("_cell")))

    low, high = at(F.floor("pos")), at(F.ceil("pos"))
    found = ranked.groupBy(*keys, "name", "pos").agg(low.alias("_lo"), high.alias("_hi"))
    exact = found.withColumn(
        "_value",
        F.when(F.col("_lo").isNull() | F.col("_hi").isNull(),
               F.raise_error(F.lit("a quantile fell outside its bracket")).cast("double"))
        .otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("pos") - F.floor("pos"))),
    )
    out = exact.groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == name, F.col("_value"))).alias(name) for name in probs]
    )
    return out if by else out.drop("_all")
