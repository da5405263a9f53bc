"""Exact k-nearest-neighbour search, split into bounded pieces of work.

A few training rows act as pivots and cut the training set into cells. For a
test row the distances to the pivots give an upper bound on its k-th neighbour
distance and a lower bound on the distance to anything in a cell, so it is sent
only to cells that can still hold a neighbour (Lu, Shen, Chen, Ooi: Efficient
Processing of k Nearest Neighbor Joins using MapReduce, PVLDB 5(10), 2012).
Inside a cell both sides are cut into chunks of a fixed size, so a crowded cell
becomes many tasks, and every chunk returns at most k candidates per test row.

Within a chunk vectors are turned to the principal axes of a sample. Distances on
the leading axes bound the whole ones from below, so that most training rows are
dismissed after a few coordinates. Where they dismiss too few, as on evenly spread
vectors, one matrix product gives all distances but for a bounded rounding. What is
left is measured by plain differences.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions.columns import uniform
from rillstone.operators.aggregates import mode
from rillstone.session import stage

_PIECE = 2_000_000  # distances held at once inside a task
_FEW = 16  # of so many pairs one may be measured by itself; of more, a product over all is cheaper


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by plain differences, which keeps close values in the right order."""
    out = np.empty((len(a), len(b)))
    step = max(1, _PIECE // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt((diff * diff).sum(axis=2))
    return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by one matrix product, which is fast but loses the last digits."""
    return np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1) - 2 * (a @ b.T)


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """An orthonormal basis, the directions in which the vectors differ most first."""
    centred = vectors - vectors.mean(axis=0)
    _, axes = np.linalg.eigh(centred.T @ centred)
    return axes[:, ::-1]


def closest_pruned(a: np.ndarray, b: np.ndarray, k: int, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, column, distance) of the k closest columns per row, columns deciding ties, and how many distances were measured in full."""
    dims = a.shape[1]
    some, more = max(1, dims // 8), max(1, dims // 2)
    k = min(k, len(b))
    turned_a, turned_b = a @ axes, b @ axes
    # room for what the products lose in the last digits
    slack = 1e-12 * dims * (np.square(a).sum(axis=1).max(initial=0) + np.square(b).sum(axis=1).max(initial=0))
    found, full, lead = [], 0, some
    step = max(1, _PIECE // len(b))
    for start in range(0, len(a), step):
        here, turned = a[start:start + step], turned_a[start:start + step]
        part = _squares(turned[:, :lead], turned_b[:, :lead])
        if lead < dims:
            # the whole distances of the k that look closest bound the k-th closest from above
            look = np.argpartition(part, k - 1, axis=1)[:, :k]
            bound = np.square(here[:, None, :] - b[look]).sum(axis=2).max(axis=1) * (1 + 1e-9) + slack
            near = part <= bound[:, None]
            full += look.size
            if np.count_nonzero(near) * _FEW > near.size:
                part += _squares(turned[:, lead:], turned_b[:, lead:])
                lead = dims  # for the steps to come as well
        if lead == dims:
            # both the k-th and the one compared may be off by the slack
            bound = np.partition(part, k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 2 * slack
            near = part <= bound[:, None]
            full += near.size
        rows, cols = np.nonzero(near)
        kept = [(rows[:0], cols[:0], np.zeros(0))]
        for at in range(0, len(rows), max(1, _PIECE // dims)):
            r, c = rows[at:at + _PIECE // dims], cols[at:at + _PIECE // dims]
            if lead < dims:
                longer = part[r, c] + np.square(turned[r, some:more] - turned_b[c, some:more]).sum(axis=1)
                close = longer <= bound[r]
                r, c = r[close], c[close]
                full += len(r)
            diff = here[r] - b[c]
            kept.append((r, c, np.sqrt((diff * diff).sum(axis=1))))
        rows, cols, apart = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = np.lexsort((cols, apart, rows))
        rows, cols, apart = rows[order], cols[order], apart[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
        found.append((rows[first] + start, cols[first], apart[first]))
    rows, cols, apart = (np.concatenate(x) for x in zip(*found, strict=True))
    return rows, cols, apart, full


def _walk(centres: np.ndarray) -> list[int]:
    """The centres in an order that goes from each to the closest one left."""
    apart = _distances(centres, centres)
    order, here = [], 0
    while len(order) < len(centres):
        order.append(here)
        apart[:, here] = np.inf
        here = int(apart[here].argmin())
    return order


def nearest(
    train: DataFrame, test: DataFrame, key: str, vector: str, label: str, k: int,
    pivots: int | None = None, chunk_rows: int = 20_000, block_rows: int = 20_000,
) -> DataFrame:
    """The k closest training rows of every test row: (key, rank, neighbour, distance, label).

    Equal distances are ordered by the training key. By default there are as many
    pivots as chunks of training rows, from 32 to 4,096, so that a cell is about
    one chunk. A training row is copied only to blocks that visit its cell.
    """
    spark = train.sparkSession
    key_type, label_type = train.schema[key].dataType, train.schema[label].dataType
    pivots = pivots or min(max(math.ceil(train.count() / chunk_rows), 32), 4096)
    drawn = train.orderBy(uniform("pivot", key), key).limit(max(pivots, 1024)).select(vector).collect()
    sample = _matrix(pd.Series([r[0] for r in drawn]))
    centres, axes = sample[:pivots], principal_axes(sample)

    # ---- cells of the training set
    def to_cells(batches):
        for pdf in batches:
            if len(pdf):
                d = _distances(_matrix(pdf["vec"]), centres)
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell.astype("int32"), to_pivot=d[np.arange(len(d)), cell])

    vec_type = T.ArrayType(T.DoubleType())
    points = train.select(F.col(key).alias("n_key"), F.col(label).alias("n_label"), F.col(vector).cast(vec_type).alias("vec"))
    cell_schema = T.StructType([*points.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("to_pivot", T.DoubleType())])
    cells = stage(points.mapInPandas(to_cells, cell_schema))

    # Per cell: its chunks, its radius and its k smallest pivot distances; at most pivots * k numbers.
    sizes = cells.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("chunks"), F.max("to_pivot").alias("radius")).collect()
    radius = np.full(len(centres), -np.inf)
    for r in sizes:
        radius[r["cell"]] = r["radius"]
    inner = Window.partitionBy("cell").orderBy("to_pivot", "n_key")
    close = cells.select("cell", "to_pivot", "n_key", F.row_number().over(inner).alias("r")).filter(F.col("r") <= k)
    near = np.full((len(centres), k), np.inf)
    for r in close.collect():
        near[r["cell"], r["r"] - 1] = r["to_pivot"]
    sizes = spark.createDataFrame([(r["cell"], r["chunks"]) for r in sizes], "cell int, chunks int")

    # ---- test rows with the cell they lie in and the cells they have to visit
    def to_visits(batches):
        for pdf in batches:
            rows = max(1, _PIECE // near.size)
            for start in range(0, len(pdf), rows):
                part = pdf.iloc[start:start + rows]
                d = _distances(_matrix(part["vec"]), centres)
                reach = (d[:, :, None] + near[None]).reshape(len(part), -1)
                bound = np.partition(reach, k - 1, axis=1)[:, k - 1]
                visited = d - radius[None] <= bound[:, None] * (1 + 1e-9) + 1e-12
                yield part.assign(home=d.argmin(axis=1).astype("int32"),
                                  cells=[np.flatnonzero(v).astype("int32") for v in visited])

    queries = test.select(F.col(key).alias("q_key"), F.col(vector).cast(vec_type).alias("vec"))
    visit_schema = T.StructType([*queries.schema.fields, T.StructField("home", T.IntegerType()),
                                 T.StructField("cells", T.ArrayType(T.IntegerType()))])
    placed = stage(queries.mapInPandas(to_visits, visit_schema))

    # a block holds the test rows of cells near each other, or a share of those of one crowded cell
    counts = {r["home"]: r["count"] for r in placed.groupBy("home").count().collect()}
    bundles, filled = [], 0
    for home in _walk(centres):
        rows = counts.get(home, 0)
        full = filled + rows > block_rows
        filled = rows if full else filled + rows
        if rows:
            bundles.append((home, bundles[-1][1] + full if bundles else 0, math.ceil(rows / block_rows)))
    bundles = spark.createDataFrame(bundles, "home int, block int, shares int")
    blocks = placed.join(bundles, "home").withColumn("share", F.pmod(F.xxhash64("q_key"), F.col("shares")).cast("int"))
    blocks = blocks.select("q_key", "vec", "block", "share", F.explode("cells").alias("cell"))
    visits = blocks.join(sizes, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    # aliased, because both sides of the grouping come from the same columns
    routes = blocks.select(*[F.col(c).alias(c) for c in ("cell", "block", "share")]).distinct()
    chunk = F.pmod(F.xxhash64("n_key"), F.col("chunks")).cast("int")
    copies = cells.drop("to_pivot").join(sizes, "cell").withColumn("chunk", chunk).drop("chunks").join(routes, "cell")

    # ---- candidates of each chunk of a cell and block
    out_schema = T.StructType([
        T.StructField("q_key", key_type), T.StructField("n_key", key_type),
        T.StructField("n_label", label_type), T.StructField("distance", T.DoubleType())])

    def candidates(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({f.name: [] for f in out_schema})
        right = right.sort_values("n_key", ignore_index=True)
        rows, cols, apart, _ = closest_pruned(_matrix(left["vec"]), _matrix(right["vec"]), k, axes)
        return pd.DataFrame({
            "q_key": left["q_key"].to_numpy()[rows], "n_key": right["n_key"].to_numpy()[cols],
            "n_label": right["n_label"].to_numpy()[cols], "distance": apart})

    group = ["cell", "chunk", "block", "share"]
    found = visits.groupBy(*group).cogroup(copies.groupBy(*group)).applyInPandas(candidates, out_schema)
    best = Window.partitionBy("q_key").orderBy("distance", "n_key")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("q_key").alias(key), "rank", F.col("n_key").alias("neighbour"), "distance",
                         F.col("n_label").alias(label))


def vote(neighbours: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """Most frequent label among the k closest, the smallest on a tie."""
    return mode(neighbours.filter(F.col("rank") <= k), [key], label, name="prediction")


def error_by_k(neighbours: DataFrame, truth: DataFrame, key: str, label: str, k_max: int) -> DataFrame:
    """Error rate for every k up to ``k_max`` from one ranked neighbour table."""
    counted = neighbours.withColumn("k", F.explode(F.sequence(F.col("rank"), F.lit(k_max))))
    votes = mode(counted, [key, "k"], label, name="prediction")
    wrong = votes.join(truth.select(key, F.col(label).alias("_truth")), key)
    return wrong.groupBy("k").agg(F.avg((F.col("prediction") != F.col("_truth")).cast("double")).alias("error_rate"))
