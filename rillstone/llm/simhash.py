"""SimHash near-duplicates, found through deletion variants of fingerprint segments.

A fingerprint has 64 bits; ``distance`` of them may differ. Cut into
``distance // 2 + 1`` segments, one of them differs by at most one bit, so two
fingerprints that link agree on that segment with one bit left out. Each
fingerprint is indexed under its segments with every single bit left out: 64
variants, whatever the distance. Rows of equal variants are compared by bit
distance, and only links that span their groups leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import mixed, trim
from rillstone.llm.components import components
from rillstone.session import stage

BITS = 64


def fingerprint(text: bytes, width: int, seed: int = 42) -> int:
    """The SimHash of the text's word shingles: a bit is set where over half of the shingle hashes set it."""
    words = text.lower().split()  # bytes: lower() touches A-Z only, split() cuts at space and 09-0D
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    count = max(1, len(words) - width + 1)
    first, last = starts[:count].tolist(), (starts + lengths)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for k in range(0, count, 1 << 16):
        part = zip(first[k : k + (1 << 16)], last[k : k + (1 << 16)], strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in part], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", width: int = 4, name: str = "fp") -> DataFrame:
    """Add the fingerprint of each text as a signed long; NULL is the empty text, whose fingerprint is 0."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        # one text at a time as bytes, whatever the batch holds
        found = pa.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", width) for t in texts], pa.int64())
        trim()
        return found

    return df.withColumn(name, of(F.col(text)))


def segments(distance: int) -> list[tuple[int, int]]:
    """First bit and length of each segment."""
    n = distance // 2 + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(distance: int) -> list[tuple[int, int, int]]:
    """For each bit: the bit, the mask of the rest of its segment, the mask of its segment."""
    out = []
    for first, length in segments(distance):
        whole = ((1 << length) - 1) << first
        out += [(b, _signed(whole & ~(1 << b)), _signed(whole)) for b in range(first, first + length)]
    return out


def spanning(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what verified pairs with an equal key connect: each fingerprint and the least of its group."""
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    nodes, at = np.unique(fp, return_inverse=True)
    root = np.arange(len(nodes))
    same = np.flatnonzero(key[1:] == key[:-1])  # row i and its next have one key
    step = 1
    while len(same):
        a, b = at[same], at[same + step]
        near = np.bitwise_count((fp[same] ^ fp[same + step]).view(np.uint64)) <= distance
        a, b = a[near], b[near]
        while len(a):
            x, y = root[a], root[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(nxt := root[root], root):
                root = nxt
        step += 1
        same = same[same + step < len(key)]
        same = same[key[same + step] == key[same]]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _edges(batch: pa.Table, distance: int) -> pa.Table:
    key = batch["key"].to_numpy().astype(np.int64)
    bit = batch["bit"].to_numpy().astype(np.int64)
    # one number for both; should two groups ever share it, the bit distance still tells them apart
    both = mixed(key.view(np.uint64) ^ mixed(bit.view(np.uint64) + np.uint64(1)))
    u, v = spanning(both, batch["fp"].to_numpy().astype(np.int64), distance)
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def links(prints: DataFrame, distance: int = 4, group: int = 4096) -> DataFrame:
    """Links ``u, v`` that connect all fingerprints (column ``fp``, distinct) which differ in ``distance`` bits or fewer.

    Groups of equal variants with up to ``group`` fingerprints are compared
    where they land. Larger ones are told beforehand by the counts of whole
    segment values (a variant joins two of them) and are dealt out as pairs of
    blocks, so no task gets more than two blocks of one group. No pair is
    dropped and none is written: a task returns at most a link per fingerprint.
    """
    masks = _masks(distance)
    variants = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(b).cast("byte").alias("bit"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for b, m, _ in masks])).alias("x")).select("fp", "x.bit", "x.key")
    whole = prints.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("seg"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
        for s, m in enumerate(dict.fromkeys(w for _, _, w in masks))])).alias("x")).select("x.*")
    large = stage(whole.groupBy("seg", "value").count().filter(F.col("count") > group // 2))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from _edges(pa.Table.from_batches(held), distance).to_batches()

    if large.isEmpty():
        return variants.repartition("bit", "key").mapInArrow(streamed, "u long, v long")

    number = {w: s for s, w in enumerate(dict.fromkeys(w for _, _, w in masks))}
    hot = large.select("count", F.explode(F.array(*[
        F.struct(F.lit(b).cast("byte").alias("bit"), F.col("value").bitwiseAND(F.lit(m)).alias("key"),
                 F.lit(number[w]).alias("of")) for b, m, w in masks])).alias("x"), "seg")
    hot = stage(hot.filter("x.of = seg").groupBy("x.bit", "x.key").agg(
        F.ceil(2 * F.sum("count") / F.lit(group)).cast("int").alias("blocks")))
    # a segment value under the mark that shares a variant with a marked one adds half a group at most
    rest = variants.join(hot, ["bit", "key"], "left_anti")
    near = rest.repartition("bit", "key").mapInArrow(streamed, "u long, v long")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = variants.join(hot, ["bit", "key"]).withColumn("i", mine).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("bit", "key", "fp", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    far = pairs.groupBy("bit", "key", "i", "j").applyInArrow(
        lambda t: _edges(t, distance), "u long, v long")
    return near.unionByName(far)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4,
) -> DataFrame:
    """``doc_id, fp, component_id, text_hash, root`` for each row.

    ``component_id`` is the smallest id among the texts whose fingerprints are
    linked, ``root`` the smallest fingerprint of the group, ``text_hash`` tells
    rows apart that share an id.

    Equal fingerprints are one node, so copies of one text cost one row. NULL
    and wordless texts have fingerprint 0 and link like any other. Rows without
    an id take part and never name a component; one of only such rows has a
    NULL component. Rows that repeat an id are one document. An empty table
    gives an empty one; other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("text_hash"))
    prints = stage(fingerprints(rows, "_text", width).drop("_text"))
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp"), distance))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stage(placed)
    named = stage(placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root")
                  .select("fp", "component_id", "root"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id", "text_hash", "root")


def without_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4,
) -> DataFrame:
    """The rows of one document of each group: the smallest id, of equal ids one text.

    Rows without an id stay only in groups without any id. Rows equal in id and
    text are one document and stay together.
    """
    found = near_duplicates(docs, doc_id, text, width, distance)
    one = F.struct("doc_id", "text_hash")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    keep = stage(found.groupBy("root").agg(F.min_by(one, first).alias("one")).select(
        F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")))
    here = F.col(f"`{doc_id}`").eqNullSafe(F.col("_id")) & (F.xxhash64(f"`{text}`") == F.col("_hash"))
    return docs.join(keep, here, "left_semi")
