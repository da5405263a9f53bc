"""Filling gaps from neighbours in time, level by level, without a one-task sort.

A fill looks at every earlier (or later) row of an entity, so a plain window
sends all rows of an entity - for the whole-table level, all rows - to one
task. Here the rows are cut into ranges of the common time order. Each range
is filled on its own, starting from the value carried into it:

1. range-partition by the order columns and write the rows with their place in
   that order (``session.stage``), so the cut is the same in every later pass;
2. per range and entity keep the first and last known value of each measure
   (combined map-side), and fill that small table over the ranges;
3. put these carried values in as extra first and last rows of each range,
   shuffle once by range, and run the ordinary windows inside it.

A coarser level is scanned only for measures that an entity of each finer level
has no value of; a measure known nowhere is not scanned at all.

A range is a slice of the sort order, so neither a hot entity nor a hot
timestamp can make one range large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.session import stage

BLOCK, POSITION, LEVEL = "_block", "_position", "_level"
# positions of the carried rows: before and after every row of a block
FIRST, LAST = -(2**62), 2**62


def with_positions(df: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """Rows with their place in the sort order, and the range it falls in, fixed by a write.

    The place is one number, so later sorts compare a long, not all order columns.
    """
    ranged = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    numbered = ranged.sortWithinPartitions(*order).withColumn(POSITION, F.monotonically_increasing_id())
    # the id holds the partition, that is the range, above its lowest 33 bits
    return stage(numbered).withColumn(BLOCK, F.shiftright(POSITION, 33).cast("int"))


def _ends(rows: DataFrame, levels: list[list[str]], measures: list[str]) -> DataFrame:
    """First and last known value of each measure per block and entity, with the entity's level.

    All levels are aggregated in one pass over the rows, as grouping sets.
    """
    keys = _keys(levels)
    # a bit of the grouping id is set when its column (block, *keys) is not grouped by
    ids = [sum(1 << (len(keys) - 1 - j) for j, k in enumerate(keys) if k not in level) for level in levels]
    number = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col("_gid").cast("int")).cast("int") - 1
    return rows.groupingSets([[BLOCK, *level] for level in levels], BLOCK, *keys).agg(
        F.grouping_id().alias("_gid"),
        *[F.expr(f"max_by(`{m}`, if(`{m}` is null, null, {POSITION}))").alias(f"{m}_end") for m in measures],
        *[F.expr(f"min_by(`{m}`, if(`{m}` is null, null, {POSITION}))").alias(f"{m}_start") for m in measures],
    ).withColumn(LEVEL, number).drop("_gid")


def _keys(levels: list[list[str]]) -> list[str]:
    return list(dict.fromkeys(k for level in levels for k in level))


def _wanted(ends: DataFrame, levels: list[list[str]], measures: list[str]) -> list[list[str]]:
    """Per level, the measures that some entity of each finer level knows no value of.

    A measure known nowhere is wanted at no level. One row per level reaches the driver.
    """
    known = ends.groupBy(LEVEL, *_keys(levels)).agg(*[(F.count(f"{m}_end") > 0).alias(m) for m in measures])
    found = {r[LEVEL]: r for r in known.groupBy(LEVEL).agg(
        *[F.min(m).alias(f"all_{m}") for m in measures], *[F.max(m).alias(f"any_{m}") for m in measures]).collect()}
    wanted, missing = [], [m for m in measures if found and found[0][f"any_{m}"]]
    for level in range(len(levels)):
        wanted.append(missing)
        missing = [m for m in missing if not found[level][f"all_{m}"]]
    return wanted


def _edge_rows(ends: DataFrame, levels: list[list[str]], measures: list[str]) -> DataFrame:
    """Two rows per block and entity: the last values known before it, the first known after it."""
    keys = _keys(levels)
    # one row per block and entity is left, so these windows are short
    entity = ", ".join([LEVEL, *[f"`{k}`" for k in keys]])
    sides = {"_in": (FIRST, "end", ""), "_out": (LAST, "start", " desc")}
    structs = []
    for name, (position, edge, direction) in sides.items():
        over = f"over (partition by {entity} order by {BLOCK}{direction} rows between unbounded preceding and 1 preceding)"
        near = [f"last(`{m}_{edge}`, true) {over} as `{m}`" for m in measures]
        structs.append(f"struct({position}L as {POSITION}, {', '.join(near)}) as {name}")
    carried = ends.selectExpr("*", *structs)
    edges = carried.select(BLOCK, *keys, LEVEL, F.inline(F.array("_in", "_out")))
    return edges.filter(" or ".join(f"`{m}` is not null" for m in measures))


def _scan(
    rows: DataFrame, kept: list[str], measures: list[str], level: int, keys: list[str], back: bool,
) -> DataFrame:
    """Give the measures still unknown the nearest value so far, or onward when ``back``.

    The backward scan runs over the reversed order, because a frame reaching
    forward would be evaluated from scratch for every row. One answer per
    measure is kept, so rows do not widen with every scan.
    """
    entity = ", ".join([BLOCK, *[f"`{k}`" for k in keys]])
    over = (f"over (partition by {entity} order by {POSITION}{' desc' if back else ''} "
            "rows between unbounded preceding and current row)")
    others = [f"`{c}`" for c in rows.columns if c not in kept and c.removeprefix("_got_") not in measures]
    return rows.selectExpr(
        *[f"`{c}`" for c in kept], *others,
        *[f"coalesce(`_got_{m}`, last(if({LEVEL} in (-1, {level}), `{m}`, null), true) {over}) as `_got_{m}`"
          for m in measures],
    )


def _scan_both(rows: DataFrame, kept: list[str], measures: list[str], level: int, keys: list[str]) -> DataFrame:
    """Give the measures still unknown the nearest value so far, else the nearest onward, with one sort.

    A row with nothing known up to it has the first known value of its entity
    as the nearest onward, and that is one value for all such rows.
    """
    entity = ", ".join([BLOCK, *[f"`{k}`" for k in keys]])
    over = f"over (partition by {entity} order by {POSITION} rows between unbounded preceding and"
    others = [f"`{c}`" for c in rows.columns if c not in kept and c.removeprefix("_got_") not in measures]
    known = {m: f"if({LEVEL} in (-1, {level}), `{m}`, null)" for m in measures}
    return rows.selectExpr(
        *[f"`{c}`" for c in kept], *others,
        *[f"coalesce(`_got_{m}`, last({known[m]}, true) {over} current row), "
          f"first({known[m]}, true) {over} unbounded following)) as `_got_{m}`" for m in measures],
    )


def _filled(
    df: DataFrame, measures: list[str], levels: list[list[str]], order: list[str], blocks: int | None,
    scans: tuple[bool, ...], own_first: bool,
) -> DataFrame:
    rows = with_positions(df, order, blocks).withColumn(LEVEL, F.lit(-1))
    ends, wanted = _ends(rows, levels, measures), [measures]
    if len(levels) > 1:
        ends = stage(ends)  # a small table, read twice
        wanted = _wanted(ends, levels, measures)
        ends = ends.filter(F.col(LEVEL).isin([i for i, w in enumerate(wanted) if w]))
    parts = rows.unionByName(_edge_rows(ends, levels, measures), allowMissingColumns=True).repartition(BLOCK)
    kept = parts.columns
    found = "`{}`" if own_first else "null"
    parts = parts.selectExpr("*", *[f"{found.format(m)} as `_got_{m}`" for m in measures])
    for level, keys in enumerate(levels):
        if wanted[level] and len(scans) > 1:
            parts = _scan_both(parts, kept, wanted[level], level, keys)
            continue
        for back in scans if wanted[level] else ():
            parts = _scan(parts, kept, wanted[level], level, keys, back)
    return parts.filter(F.col(POSITION).between(FIRST + 1, LAST - 1)).selectExpr(
        *[f"`_got_{c}` as `{c}`" if c in measures else f"`{c}`" for c in df.columns]
    )


def hierarchical_fill(
    df: DataFrame, measures: list[str], levels: list[list[str]], order: list[str], blocks: int | None = None,
) -> DataFrame:
    """Fill each measure from its own row, then backwards and onwards in time at each level in turn.

    ``order`` must be unique within each entity. An empty level is the whole table.
    """
    return _filled(df, measures, levels, order, blocks, scans=(False, True), own_first=True)


def forward_fill(df: DataFrame, measures: list[str], keys: list[str], order: list[str], blocks: int | None = None) -> DataFrame:
    """Last known value of the entity up to each row."""
    return _filled(df, measures, [keys], order, blocks, scans=(False,), own_first=False)


def backward_fill(df: DataFrame, measures: list[str], keys: list[str], order: list[str], blocks: int | None = None) -> DataFrame:
    """Next known value of the entity from each row on."""
    return _filled(df, measures, [keys], order, blocks, scans=(True,), own_first=False)
