"""A prefix trie of conversations: ternary search trees per range of sequences, joined at their borders.

Conversations become sequences of turn digests. Equal sequences are gathered
into one, the sequences are dealt out by range, and each range numbers its own
turns and inserts its sequences, the median first, into a ternary search tree.
A node that no other range can hold is finished there. Nodes on the way to a
range's first or last sequence are left open; 64 neighbouring ranges at a time
add theirs up, finish all but those on their common border, and so on until one
range is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import parts_for
from rillstone.session import stage

WORD = r"[^\x20\x09-\x0D]+"
DIGEST = 16  # bytes of a turn's digest
RUN = 512  # ids of one piece of a list of ids
FAN = 64  # ranges joined in one step
NO_ENDS = hashlib.sha256(b"").hexdigest()

_PIECES = "seq binary, words array<long>, first long, n long, ids binary"
_NODES = ("shard int, first boolean, last boolean, key binary, parent_key binary, conv_id long, depth long, "
          "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, "
          "ends_sha256 string")
_COLUMNS = [c.split()[0] for c in _NODES.split(", ")]
_ARROW = pa.schema([("shard", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()), ("key", pa.binary()),
                    ("parent_key", pa.binary()), *[(c, pa.int64()) for c in _COLUMNS[5:13]],
                    ("ends_sha256", pa.string())])


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of role and text; the role's length keeps them apart."""
    both = F.concat(F.length(role).cast("string"), F.lit(" "), role, text)
    return F.unhex(F.substring(F.sha2(both, 256), 1, 2 * DIGEST))


def sequences(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``conv_id, digests, words``: each conversation's turns in order, and the words of their texts.

    NULL turns come first, equal ones in the order of their digests; a NULL role
    or text is empty; rows without a conversation are left out. A row is as large
    as its conversation, 24 bytes a turn.
    """
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    one = F.struct(F.col("turn").isNotNull().alias("dated"), "turn", turn_digest(F.col("role"), F.col("text")).alias("digest"),
                   F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    rows = rows.filter("conv_id is not null").select("conv_id", one.alias("one"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    return rows.select("conv_id", F.col("all.digest").alias("digests"), F.col("all.words").alias("words"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of sequence and id, one for up to ``RUN`` ids of a sequence."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        seqs, ids = batch.column("seq"), batch.column("conv_id").to_pylist()
        new = np.r_[True, pc.not_equal(seqs.slice(1), seqs.slice(0, n - 1)).to_numpy(zero_copy_only=False)]
        starts = np.flatnonzero(new)
        starts = np.concatenate([np.arange(a, b, RUN) for a, b in zip(starts, np.r_[starts[1:], n], strict=True)])
        ends = np.r_[starts[1:], n].tolist()
        joined = [",".join(map(str, ids[a:b])).encode() for a, b in zip(starts.tolist(), ends, strict=True)]
        at = pa.array(starts)
        yield pa.RecordBatch.from_arrays([
            seqs.take(at), batch.column("words").take(at), batch.column("conv_id").take(at),
            pa.array(np.asarray(ends) - starts, pa.int64()),
            pa.array(joined, pa.binary())], ["seq", "words", "first", "n", "ids"])


class TernaryTree:
    """A trie whose children are ternary search trees: ``lo`` and ``hi`` lead to sisters, ``eq`` to the next turn."""

    def __init__(self):
        self.ident, self.lo, self.hi, self.eq, self.words = [-1], [-1], [-1], [-1], [0]

    def _new(self, code: int, words: int) -> int:
        for column, value in ((self.ident, code), (self.lo, -1), (self.hi, -1), (self.eq, -1), (self.words, words)):
            column.append(value)
        return len(self.ident) - 1

    def insert(self, codes: list[int], words: list[int]) -> int:
        """The node of the whole sequence; the nodes on its way are made."""
        ident, at = self.ident, 0
        for code, n in zip(codes, words, strict=True):
            links, k = self.eq, at
            while links[k] >= 0:
                k = links[k]
                if ident[k] == code:
                    break
                links = self.lo if code < ident[k] else self.hi
            else:
                links[k] = self._new(code, n)
                k = links[k]
            at = k
        return at

    def path(self, codes: list[int]) -> list[int]:
        """The nodes on the way to a sequence that is there, the root included."""
        found = [0]
        for code in codes:
            k = self.eq[found[-1]]
            while self.ident[k] != code:
                k = self.lo[k] if code < self.ident[k] else self.hi[k]
            found.append(k)
        return found

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """All nodes, parents before children, and each node's parent and depth."""
        order, parent, depth = [], [-1] * len(self.ident), [0] * len(self.ident)
        stack = [0]
        while stack:
            k = stack.pop()
            order.append(k)
            for sister in (self.lo[k], self.hi[k]):
                if sister >= 0:
                    parent[sister], depth[sister] = parent[k], depth[k]
                    stack.append(sister)
            child = self.eq[k]
            if child >= 0:
                parent[child], depth[child] = k, depth[k] + 1
                stack.append(child)
        return order, parent, depth


def median_first(n: int) -> Iterator[int]:
    """The numbers below ``n``: the middle one, then the middles of both halves, and so on."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            todo += [(m + 1, b), (a, m)]


def _key(parent: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(parent + digest).digest()[:DIGEST]


def _range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range: finished ones without a key, open ones with theirs."""
    from pyspark import TaskContext

    seqs, words, least, count, ends = [], [], [], [], []
    for batch in batches:
        for seq, w, first, n, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if seqs and seqs[-1] == seq:
                count[-1] += n
                ends[-1].update(b",")
            else:
                seqs.append(seq)
                words.append(w)
                least.append(first)
                count.append(n)
                ends.append(hashlib.sha256())
            ends[-1].update(ids)
    if not seqs:
        return
    _, codes = np.unique(np.frombuffer(b"".join(seqs), f"S{DIGEST}"), return_inverse=True)
    offsets = np.r_[0, np.cumsum([len(s) // DIGEST for s in seqs])].tolist()
    codes = [codes[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    tree = TernaryTree()
    end_of = {tree.insert(codes[k], words[k]): k for k in median_first(len(seqs))}
    order, parent, depth = tree.walk()
    size = len(order)
    n_convs, lowest = [0] * size, [None] * size
    for node, k in end_of.items():
        n_convs[node], lowest[node] = count[k], least[k]
    keys, flags = {}, [set(), set()]
    for side, k in ((0, 0), (1, len(seqs) - 1)):
        key = b""
        for d, node in enumerate(tree.path(codes[k])):
            if d:
                key = _key(key, seqs[k][(d - 1) * DIGEST:d * DIGEST])
            keys[node] = key
            flags[side].add(node)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for k in reversed(order):
        up = parent[k]
        if k not in keys:
            leaves[k] += not children[k]
            saved[k] += (n_convs[k] - 1) * tree.words[k]
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
        if up >= 0:
            n_convs[up] += n_convs[k]
            lowest[up] = lowest[k] if lowest[up] is None else min(lowest[up], lowest[k])
    shard = TaskContext.get().partitionId()
    for a in range(0, size, 10_000):
        some = order[a:a + 10_000]
        closed = [k not in keys for k in some]
        # the smallest member of a finished parent is known; an open one is asked for by its key
        yield pa.RecordBatch.from_arrays([
            pa.array([shard] * len(some), pa.int32()), pa.array([k in flags[0] for k in some]),
            pa.array([k in flags[1] for k in some]), pa.array([keys.get(k) for k in some], pa.binary()),
            pa.array([keys.get(parent[k]) for k in some], pa.binary()),
            *[pa.array([x[k] for k in some], pa.int64()) for x in (lowest, depth)],
            pa.array([lowest[parent[k]] if parent[k] >= 0 and parent[k] not in keys else None for k in some], pa.int64()),
            *[pa.array([x[k] for k in some], pa.int64()) for x in (n_convs, children, leaves, saved, tree.words)],
            pa.array([ends[end_of[k]].hexdigest() if k in end_of else NO_ENDS if done else None
                      for k, done in zip(some, closed, strict=True)], pa.string())], schema=_ARROW)


def _join_borders(table: pa.Table) -> pa.Table:
    """Open nodes of neighbouring ranges added up; those that are not on the common border come out finished."""
    rows = table.to_pylist()
    low, high = min(r["shard"] for r in rows), max(r["shard"] for r in rows)
    group, whole = rows[0]["shard"] // FAN, rows[0]["whole"]
    nodes: dict[bytes, dict] = {}
    for r in rows:
        r["first"] = r["first"] and r["shard"] == low and not whole
        r["last"] = r["last"] and r["shard"] == high and not whole
        known = nodes.setdefault(r["key"], r)
        if known is not r:
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                known[c] += r[c]
            known["conv_id"] = min(known["conv_id"], r["conv_id"])
            known["first"] |= r["first"]
            known["last"] |= r["last"]
            known["ends_sha256"] = known["ends_sha256"] or r["ends_sha256"]
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        r["shard"] = group
        if r["first"] or r["last"]:
            continue
        r["n_leaves"] += not r["n_children"]
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        r["ends_sha256"] = r["ends_sha256"] or NO_ENDS
        if r["depth"]:
            up = nodes[r["parent_key"]]
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved_tokens"] += r["saved_tokens"]
    return pa.Table.from_pylist(list(nodes.values()), _ARROW)


def trie(seqs: DataFrame, each: int = 4 << 20) -> DataFrame:
    """All nodes of the trie over ``conv_id, digests, words``; ``each``: bytes of the digests in one range.

    Returns ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``. A conversation without a
    turn is a member of the root; without any conversation there is no node.
    """
    rows = stage(seqs.select("conv_id", F.unhex(F.array_join(F.transform("digests", F.hex), "")).alias("seq"), "words"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("seq").cast("long")), F.lit(0))).first()[0]
    parts = parts_for(rows, size, each)
    ordered = rows.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    pieces = stage(ordered.select("seq", "words", "conv_id").mapInArrow(_pieces, _PIECES))
    ranges = pieces.repartitionByRange(parts, "seq").sortWithinPartitions("seq", "first")
    nodes = stage(ranges.mapInArrow(_range, _NODES))
    closed, left = nodes.filter("key is null"), nodes.filter("key is not null")
    borders = None
    while True:
        count = left.agg(F.max("shard")).first()[0]
        whole = count is None or count < FAN
        grouped = left.withColumn("whole", F.lit(whole)).groupBy(F.floor(F.col("shard") / FAN).alias("group"))
        joined = stage(grouped.applyInArrow(_join_borders, _NODES))
        done = joined.filter("not (first or last)")
        borders = done if borders is None else borders.unionByName(done)
        if whole:
            break
        left = joined.filter("first or last")
    known = borders.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("least"))
    asked = closed.filter("parent_key is not null").unionByName(borders).join(known, "parent_key", "left")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    asked = asked.withColumn("parent_conv_id", F.col("least"))
    return closed.filter("parent_key is null").select(*out).unionByName(asked.select(*out))
