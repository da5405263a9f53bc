"""Packing of documents into sequences, planned on the histogram of piece lengths.

Shortest-pack-first: lengths are placed from the longest to the shortest, each
into the pack with the most room, and packs of one kind are counted, not
listed. Where no pack has room, pieces of one length fill the packs they open,
so a length that many pieces have leaves no more room than any other. The
plan's size depends on the sequence length only; pieces learn their place from
their length and their rank among the pieces of that length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import trim
from rillstone.llm.tokens import batches, file_ids
from rillstone.session import stage


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of packs (their lengths, longest first) and how many of each hold every length of the histogram."""
    open_: dict[int, list[list]] = {}  # room -> kinds of packs, each [lengths, count]
    rooms: list[int] = []
    done = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and not open_.get(-rooms[0]):
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else -1
            if room >= length:
                kind, count = open_[room].pop()
                taken = min(count, left)
                if count > taken:
                    open_[room].append([kind, count - taken])
                many = 1
            else:  # what fills no whole pack opens one more the next time round
                many = min(capacity // length, left)
                kind, taken, room = (), left // many, capacity
            left -= taken * many
            room -= length * many
            kind = (*kind, *(length,) * many)
            if not room:
                done.append((kind, taken))
                continue
            if not open_.get(room):
                open_[room] = []
                heapq.heappush(rooms, -room)
            open_[room].append([kind, taken])
    return done + [(kind, count) for kinds in open_.values() for kind, count in kinds]


class Plan:
    """For each length, ranges of ranks and the packs and offsets that they fill."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        slots, base = [], 0
        used = dict.fromkeys(histogram, 0)
        self.slots = 0
        offsets = []
        for kind, count in patterns(histogram, capacity):
            starts = np.cumsum((0, *kind[:-1]))
            for length in dict.fromkeys(kind):
                places = [int(s) for s, x in zip(starts, kind, strict=True) if x == length]
                slots.append((length, used[length], base, len(places), len(offsets)))
                offsets += places
                used[length] += count * len(places)
            base += count
        slots.sort()
        self.sequences = base
        self.length, self.rank, self.base, self.many, self.at = (
            np.array(x, np.int64) for x in (zip(*slots, strict=True) if slots else [[]] * 5))
        self.offsets = np.array(offsets, np.int64)
        self.first = np.searchsorted(self.length, np.arange(capacity + 2))  # of a length's ranges

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the piece that is ``rank``-th of its length."""
        steps = np.zeros(len(length), np.int64)
        size = self.first[length + 1] - self.first[length]
        low = self.first[length].copy()
        while (size > 1).any():  # a binary search in every piece's own ranges
            half = size // 2
            right = self.rank[np.minimum(low + half, len(self.rank) - 1)] <= rank
            move = (size > 1) & right
            low = np.where(move, low + half, low)
            size = np.where(size > 1, np.where(right, size - half, half), size)
        steps = rank - self.rank[low]
        return self.base[low] + steps // self.many[low], self.offsets[self.at[low] + steps % self.many[low]]


def pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048,
    end: int = 1, ids: bool = False,
) -> DataFrame:
    """Tokenise whole texts, add ``end`` to each, and cut them into pieces of at most ``capacity`` ids.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for,
    ``ids``. A NULL or empty text is the end id alone.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * ids
    last = np.array([end], "<i4").tobytes()
    step = 4 * capacity

    def cut(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = file_ids(path)
        for batch in batches(frame):
            rows: list[tuple] = []
            for doc, value in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                packed = encode(value) + last
                for at in range(0, len(packed), step):
                    piece = packed[at : at + step]
                    rows.append((doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(packed) // 4, piece))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if ids:
                values = np.frombuffer(b"".join(columns[5]), "<i4")
                bounds = np.cumsum([0, *columns[2]])
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
            trim()

    few = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return few.mapInArrow(cut, schema)


def pack(cut: DataFrame, capacity: int = 2048, each: int = 50_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces with ``length``.

    Ranks within a length are counted in shares of about ``each`` pieces, so a
    length that many pieces have is no one task's. ``cut`` must be a stored
    table (it is read twice). An empty table gives an empty one.
    """
    # at most one row per length from 1 to the capacity
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    plan = Plan(histogram, capacity)
    shares = {n: -(-c // each) for n, c in histogram.items() if c > each}
    share = F.lit(0)
    if shares:
        many = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("length")),
                          F.lit(1))
        share = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), many).cast("int")
    rows = cut.withColumn("share", share)
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(rows.groupBy("length", "share").count().select(
        "length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")))
    within = F.row_number().over(Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32"))
    ranked = rows.withColumn("within", within).join(counts, ["length", "share"]).withColumn(
        "rank", F.col("before") + F.col("within") - 1)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = plan.place(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select(*cut.columns, "place.sequence_id", "place.offset")


def packed_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 1,
) -> DataFrame:
    """Tokenise, cut and pack whole documents.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. Rows without an id and rows that repeat one are
    packed like any others; an empty table gives an empty one; other columns
    are not looked at.
    """
    return pack(stage(pieces(docs, path, doc_id, text, capacity, end)), capacity)
