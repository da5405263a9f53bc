"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors of a label are dealt to the shards of their nearest centres, two each,
so shards overlap. Each shard gets a graph: every vector keeps its nearest
neighbours, except those that a kept one is nearer to. The adjacency lists of
all shards are united. A vector is then searched for from the medoids of its
shards: best first through the united lists until the beam stands, then
through everything within range. Each link is verified by its cosine, links are
counted where they are found, and only links that span the groups leave a task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.components import components
from rillstone.session import stage


WANTED, ATTEMPTS = 0.95, 3  # a search whose audit finds less is repeated wider, so many times in all


class Settings(NamedTuple):
    """Sizes of the index; all but ``threshold`` change speed and recall only."""

    threshold: float = 0.93
    centres: int = 8192  # at most so many, from a sample of as many vectors
    per_centre: int = 512  # vectors for each centre until that bound is met
    overlap: int = 2  # shards of a vector
    shard: int = 2048  # vectors of a shard; larger ones are split
    degree: int = 24
    near: int = 48  # neighbours considered, and so many random ones more:
    far: int = 8
    slack: float = 1.2  # a neighbour goes if a kept one is nearer to it by this factor
    beam: int = 32
    margin: float = 0.05  # range search goes on through vectors this far out of range
    reach: float = 2.0  # shards are searched whose centre is so many deviations less alike than the nearest one


def usable(vector: Column) -> Column:
    """Whether a vector can link at all: finite components, one of them not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    """Vectors of one length as rows of length one."""
    values = np.array([np.asarray(v, np.float64) for v in column])
    values = values / np.abs(values).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def choose_centres(nodes: DataFrame, s: Settings) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each group: numbers and vectors of centres, from a bounded sample; none within range of another."""
    wanted = min(s.centres, -(-nodes.count() // s.per_centre))
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(wanted).select("group", "vector").collect()
    places: dict[str, list[int]] = {}
    for number, (group, _) in enumerate(sample):
        places.setdefault(group, []).append(number)
    out = {}
    for group, numbers in places.items():
        vectors, kept = _matrix([sample[k][1] for k in numbers]), []
        for k, one in enumerate(vectors):
            if not kept or (vectors[kept] @ one).max() < s.threshold:
                kept.append(k)
        out[group] = (np.array(numbers)[kept], vectors[kept])
    return out


def assign(nodes: DataFrame, centres: dict[str, tuple[np.ndarray, np.ndarray]], s: Settings) -> DataFrame:
    """Add ``cells``, the nearest centres, and ``visits``, those in which a vector in range may lie, nearest first.

    Two vectors in range lie ``sqrt(2 - 2 threshold)`` apart at most. Seen along the
    line between two centres, of all directions, that makes a small difference with a
    deviation of so much over the root of the dimensions: a centre that is less alike
    by several of these is hardly the other one's nearest. A group without a centre is
    one cell.
    """

    @F.pandas_udf("struct<cells: array<int>, visits: array<int>>")
    def nearest(group: pd.Series, vector: pd.Series) -> pd.DataFrame:
        cells = pd.Series([[-1]] * len(group), dtype=object)
        visits = cells.copy()
        for name, places in pd.Series(np.arange(len(group))).groupby(group.to_numpy()):
            if name not in centres:
                continue
            numbers, vectors = centres[name]
            for a in range(0, len(places), 512):
                some = places.iloc[a : a + 512]
                alike = _matrix(vector.iloc[some]) @ vectors.T
                order = np.argsort(-alike, axis=1, kind="stable")
                ranked = np.take_along_axis(alike, order, 1)
                apart = np.sqrt(2 * (2 - 2 * s.threshold) / vectors.shape[1])  # centres are about sqrt(2) apart
                many = np.maximum((ranked >= ranked[:, :1] - s.reach * apart).sum(1), s.overlap)
                for at, row, n in zip(some, numbers[order].tolist(), many.tolist(), strict=True):
                    cells.iat[at], visits.iat[at] = row[: s.overlap], row[:n]
        return pd.DataFrame({"cells": cells, "visits": visits})

    return nodes.withColumn("_near", nearest("group", "vector")).select("*", "_near.cells", "_near.visits").drop("_near")


def prune(vectors: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Robust pruning within one shard: for each vector the places of its neighbours, both ways."""
    size = len(vectors)
    if size < 2:
        return [np.zeros(0, np.int64)] * size
    alike = vectors @ vectors.T
    np.fill_diagonal(alike, -np.inf)
    near = min(s.near, size - 1)
    found = np.argpartition(-alike, near - 1, axis=1)[:, :near]
    chance = np.random.default_rng(size).integers(0, size, (size, s.far))
    found = np.concatenate([found, chance], axis=1)
    order = np.argsort(-np.take_along_axis(alike, found, 1), axis=1, kind="stable")
    found = np.take_along_axis(found, order, 1)
    np.fill_diagonal(alike, 1.0)
    apart = np.sqrt(np.maximum(2 - 2 * alike, 0))
    away = np.take_along_axis(apart, found, 1)
    own = np.arange(size)
    alive = found != own[:, None]
    heads, tails = [], []
    for _ in range(s.degree):
        rows = np.flatnonzero(alive.any(1))
        if not len(rows):
            break
        pick = found[rows, alive[rows].argmax(1)]
        heads.append(rows)
        tails.append(pick)
        alive[rows] &= s.slack * apart[pick[:, None], found[rows]] > away[rows]
        alive[rows] &= found[rows] != pick[:, None]
    head, tail = np.concatenate(heads + tails), np.concatenate(tails + heads)
    pairs = np.unique(head * size + tail)
    return np.split(pairs % size, np.searchsorted(pairs // size, np.arange(1, size)))


def _shard_graph(table: pa.Table, s: Settings) -> pa.Table:
    node = table["node"].to_numpy()
    order = np.argsort(node)
    node = node[order]
    lists = prune(_matrix(table["vector"].to_pylist())[order], s)
    return pa.table({"node": pa.array(node, pa.int64()),
                     "beside": pa.array([node[x].tolist() for x in lists], pa.list_(pa.int64()))})


class Region:
    """A shard's vectors with the united lists, as far as they stay inside."""

    def __init__(self, node: np.ndarray, vectors: np.ndarray, beside: list, s: Settings):
        order = np.argsort(node)
        self.node, self.vectors, self.s = node[order], vectors[order], s
        lists = [np.asarray(beside[k], np.int64) for k in order]
        owner = np.repeat(np.arange(len(node)), [len(x) for x in lists])
        flat = np.concatenate(lists) if len(lists) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.node, flat), len(node) - 1)
        inside = self.node[at] == flat
        self.to = at[inside]
        self.edge = np.r_[0, np.cumsum(np.bincount(owner[inside], minlength=len(node)))]
        middle = self.vectors.sum(0)
        self.medoid = int((self.vectors @ middle).argmax())

    def around(self, places: np.ndarray) -> np.ndarray:
        a, b = self.edge[places], self.edge[places + 1]
        sizes = b - a
        return self.to[np.repeat(a - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]

    def search(self, vector: np.ndarray, own: int) -> np.ndarray:
        """Places of all vectors in range that the graph leads to."""
        seen = np.zeros(len(self.node), bool)
        seeds = np.array([self.medoid] if own < 0 else [self.medoid, own])
        seeds = np.unique(seeds)
        seen[seeds] = True
        place, alike = seeds, self.vectors[seeds] @ vector
        fresh = np.ones(len(place), bool)  # not yet expanded
        reach = self.s.threshold - self.s.margin
        while True:
            top = np.argsort(-alike, kind="stable")[: self.s.beam]
            open_ = fresh & (alike >= reach)
            open_[top] |= fresh[top]
            if not open_.any():
                break
            fresh &= ~open_
            more = np.unique(self.around(place[open_]))
            more = more[~seen[more]]
            seen[more] = True
            place = np.r_[place, more]
            alike = np.r_[alike, self.vectors[more] @ vector]
            fresh = np.r_[fresh, np.ones(len(more), bool)]
        return place[alike >= self.s.threshold]


def _search(table: pa.Table, s: Settings) -> pa.Table:
    """Links of a region's queries: their number for each, and a spanning set of them."""
    frame = table.to_pandas()
    there, asked = frame[frame["asks"] < 0], frame[frame["asks"] >= 0]
    if not len(there) or not len(asked):
        return _found([], [], [], [])
    region = Region(there["node"].to_numpy(), _matrix(there["vector"]), list(there["beside"]), s)
    order = np.argsort(there["node"].to_numpy())
    copies = there["copies"].to_numpy()[order]
    cells = [set(c) for c in there["cells"].to_numpy()[order]]
    queries = _matrix(asked["vector"])
    nodes = np.unique(np.r_[region.node, asked["node"].to_numpy()])
    at = np.searchsorted(nodes, region.node)
    root = np.arange(len(nodes))

    def top(x: np.ndarray) -> np.ndarray:
        while not np.array_equal(y := root[x], x):
            x = y
        return x

    counts = np.zeros(len(asked), np.int64)
    for k, (node, asks, mine) in enumerate(zip(asked["node"], asked["asks"], asked["cells"], strict=True)):
        own = int(np.searchsorted(region.node, node))
        own = own if own < len(region.node) and region.node[own] == node else -1
        found = region.search(queries[k], own)
        found = found[region.node[found] != node]
        counts[k] = copies[found].sum()
        if asks and len(found):  # not the first cell asked: what an earlier one holds is counted there
            earlier = set(mine[:asks])
            counts[k] = copies[[f for f in found if not earlier & cells[f]]].sum()
        if len(found):
            group = np.unique(top(np.r_[np.searchsorted(nodes, node), at[found]]))
            root[group] = group[0]
    root = top(root)
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return _found(asked["node"].to_numpy(), counts, nodes[moved], nodes[root[moved]])


def _found(node, links, u, v) -> pa.Table:
    empty = [None] * len(u), [None] * len(node)
    return pa.table({"node": pa.array([*node, *empty[0]], pa.int64()), "links": pa.array([*links, *empty[0]], pa.int64()),
                     "u": pa.array([*empty[1], *u], pa.int64()), "v": pa.array([*empty[1], *v], pa.int64())})


def build_and_search(nodes: DataFrame, s: Settings) -> DataFrame:
    """``node, links`` and ``u, v`` rows for stored ``node, group, vector, copies``."""
    placed = stage(assign(nodes, choose_centres(nodes, s), s))
    members = placed.withColumn("cell", F.explode("cells"))
    # a row per cell: as many as there are centres and groups
    sizes = stage(members.groupBy("group", "cell").agg(F.ceil(F.count(F.lit(1)) / s.shard).cast("int").alias("blocks")))
    part = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = members.join(sizes, ["group", "cell"]).withColumn("part", part)
    graphs = members.select("group", "cell", "part", "node", "vector").groupBy("group", "cell", "part").applyInArrow(
        lambda t: _shard_graph(t, s), "node long, beside array<long>")
    united = stage(graphs.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("beside"))).alias("beside")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    there = members.join(united, "node").withColumns({"asks": F.lit(-1), "from": every})
    queries = placed.select("*", F.posexplode("visits").alias("asks", "cell")).join(sizes, ["group", "cell"])
    queries = queries.withColumns({
        "beside": F.array().cast("array<bigint>"), "from": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"),
        "part": every, "cells": F.col("visits")})
    columns = ["group", "cell", "from", "part", "asks", "node", "vector", "copies", "cells", "beside"]
    both = there.select(*columns).unionByName(queries.select(*columns))
    return both.groupBy("group", "cell", "from", "part").applyInArrow(
        lambda t: _search(t, s), "node long, links long, u long, v long")


def audit(nodes: DataFrame, links: DataFrame, s: Settings, sample: int = 400) -> float | None:
    """Recall: links found over links that comparison with every vector finds, for a bounded sample of vectors.

    Half of the sample are any vectors, half are such that have links. None where no vector of the sample has one.
    """
    few = [F.xxhash64("node", F.lit(3)), F.col("node")]
    linked = nodes.join(links.filter("links > 0").select("node"), "node", "left_semi")
    some = {r["node"]: r for rows in (nodes, linked)
            for r in rows.orderBy(*few).limit(sample // 2).select("group", "node", "vector").collect()}.values()
    groups: dict[str, tuple[list, list]] = {}
    for group, node, vector in some:
        nodes_, vectors = groups.setdefault(group, ([], []))
        nodes_.append(node)
        vectors.append(vector)
    asked = {g: (np.array(n), _matrix(v)) for g, (n, v) in groups.items()}

    @F.pandas_udf("long")
    def true_links(group: pd.Series, node: pd.Series, vector: pd.Series, copies: pd.Series) -> pd.Series:
        out = np.zeros(len(group), np.int64)
        for name, places in pd.Series(np.arange(len(group))).groupby(group.to_numpy()):
            if name in asked:
                ids, vectors = asked[name]
                alike = _matrix(vector.iloc[places]) @ vectors.T >= s.threshold
                alike &= node.to_numpy()[places][:, None] != ids
                out[places] = alike.sum(1) * copies.to_numpy()[places]
        return pd.Series(out)

    true = nodes.agg(F.sum(true_links("group", "node", "vector", "copies"))).first()[0] or 0
    ids = [r["node"] for r in some]
    found = links.filter(F.col("node").isin(ids)).agg(F.sum("links")).first()[0] or 0 if ids else 0
    return min(1.0, found / true) if true else None


def near_duplicates(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    settings: Settings = Settings(),
) -> DataFrame:
    """``vec_id, n_links, component_id, kept, recall`` for each row; only vectors of one label are compared.

    ``recall`` is the audit's; a search that misses ``WANTED`` is repeated with more
    shards for each vector, a wider beam and more shards visited. A link joins both its
    ends when one of them finds it; ``n_links`` counts what the vector's own search finds.

    A vector that is NULL, zero, or holds a NULL or non-finite component, and
    one with a NULL label, links with nothing, nor do vectors of different
    length. Equal vectors of a label are one node with a number of copies.
    Rows without an id take part and name no component; rows that repeat an id
    are vectors of their own. An empty table gives an empty one; other columns
    are not looked at.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                     F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("group", F.when(
        F.col("label").isNotNull() & usable(F.col("vector")),
        F.concat(F.size("vector").cast("string"), F.lit(" "), F.col("label"))))
    linking = rows.filter("group is not null")
    nodes = stage(linking.groupBy("group", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("node", F.monotonically_increasing_id()))
    for _ in range(ATTEMPTS):
        found = stage(build_and_search(nodes, settings))
        counted = stage(found.filter("node is not null").groupBy("node").agg(F.sum("links").alias("links")))
        recall = audit(nodes, counted, settings)
        if recall is None or recall >= WANTED:
            break
        settings = settings._replace(reach=settings.reach + 1, beam=2 * settings.beam, overlap=settings.overlap + 1)
    roots = components(found.filter("u is not null").select("u", "v"))
    placed = nodes.join(counted, "node", "left").join(roots, "node", "left").withColumns({
        "root": F.coalesce("root", "node"), "n_links": F.coalesce("links", F.lit(0)) + F.col("copies") - 1})
    placed = stage(placed.select("group", "vector", "root", "least", "n_links"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    named = stage(named.select("group", "vector", "n_links", "component_id"))
    out = linking.join(named, ["group", "vector"]).select("vec_id", "n_links", "component_id").unionByName(
        rows.filter("group is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id")))
    return out.select("vec_id", "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
                      F.lit(recall).cast("double").alias("recall"))
