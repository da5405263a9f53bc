"""Removal of repeated passages by prefix-free parsing.

Texts are cut into phrases at rolling-hash triggers. The trigger of a
``length``-byte string is the ``TRIGGER``-byte stretch inside it whose hash is
smallest, so equal strings have the same trigger at the same place, and every
string has one. A phrase is what the strings of one trigger cover: the
dictionary holds each distinct phrase once, with its first place in the
corpus, and the parse is the table of (phrase, document, position).

Strings repeat when their phrases do, or when two distinct phrases with one
trigger share a part. So the dictionary is sorted by trigger, the phrase's hash
and corpus place; every place of a phrase but the first is a repeat. Dictionary
phrases that share a trigger and bytes beside it are opened: their suffixes, cut
to ``length`` bytes, are sorted by hash and corpus place, and every one but the
first of its run is a repeat. Only equality within ``length`` bytes decides a
repeat, so these hashes (64 and 96 bits) stand in for the full suffix order of
dictionary and parse, which is not built.

Documents are read in blocks; phrases are dealt out by trigger as packed
arrays. Each block keeps the first place of a phrase and marks its own later
ones, so a phrase that every document holds costs a place per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import (
    RollingHash,
    cut_by,
    flat,
    joined,
    parts_for,
    thin,
    trim,
    utf8,
    wide,
)
from rillstone.session import stage

TRIGGER = 32
SLICE = 1 << 20  # bytes hashed at a time
_PLACE = 24  # bits that hold a place within a slice

_SPLIT = 40  # a place has so many bits; above them stands the split of its document's id

# A place is a byte's number within its block, whose documents stand in corpus order.
_MARKS = "block int, kind int, place binary, count binary"
_PHRASES = ("bucket int, kind int, block int, trigger binary, phrase binary, before binary, after binary, "
            "id binary, place binary, count binary, back binary")
_STRINGS = "bucket int, kind int, block int, string binary, id binary, place binary, count binary"
_STRING = 12  # bytes of a string's hash


def _nothing(schema: str) -> dict[str, list]:
    return {part.split()[0]: [] for part in schema.split(",")}


def _arrow(columns: dict[str, list], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(",")]
    return pa.table({name: pa.array(columns[name], kinds[kind]) for name, kind in fields})


class Block:
    """A block's documents in corpus order: by id (NULL last), then split, then text."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(
            table.select(["id", "split", "text"]), null_placement="at_end",
            sort_keys=[("id", "ascending"), ("split", "ascending"), ("text", "ascending")])
        self.table = table.take(order)
        self.split = flat(self.table["split"]).cast(pa.int64()).to_numpy()
        self.data, self.offsets = utf8(self.table["text"])
        self.ids = pc.fill_null(flat(self.table["id"]).cast(pa.int64()), np.iinfo(np.int64).max).to_numpy()

    def ranked(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each place's id, and the place led by its split, so that rows of one id keep their order across blocks."""
        doc = np.searchsorted(self.offsets, place, side="right") - 1
        return self.ids[doc], place + (self.split[doc] << _SPLIT)


def phrases(data: np.ndarray, offsets: np.ndarray, length: int):
    """``(first, last, trigger)`` places of each run of strings with one trigger; strings stay inside documents."""
    width = length - TRIGGER + 1
    ends = offsets[1:]
    bounds = np.zeros(len(data) + 1, np.int32)
    np.add.at(bounds, np.maximum(offsets[:-1], ends - (length - 1)), 1)
    np.add.at(bounds, ends, -1)
    whole = np.cumsum(bounds[:-1]) == 0  # a string can begin here
    for at in range(0, len(data), SLICE):
        here = data[at : at + SLICE + length - 1]
        n = len(here) - length + 1
        if n <= 0:
            break
        rolling = RollingHash(here)
        spots = np.arange(len(here) - TRIGGER + 1)
        hashes = rolling.of(spots, spots + TRIGGER)
        low = np.uint64((1 << _PLACE) - 1)
        least = (hashes & ~low) | (low - spots.astype(np.uint64))  # of equal hashes the last place
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if width > size:
            least = np.minimum(least[: -(width - size)], least[width - size :])
        trigger = (low - (least & low)).astype(np.int64)[:n]
        ok = whole[at : at + n]
        fresh = np.r_[True, (trigger[1:] != trigger[:-1]) | ~ok[:-1]] & ok
        first = np.flatnonzero(fresh)
        if not len(first):
            continue
        closing = np.r_[~ok[1:] | fresh[1:], True] & ok
        last = np.flatnonzero(closing)
        yield at, rolling, hashes, first, last, trigger[first]


def _parse(table: pa.Table, length: int, buckets: int) -> pa.Table:
    """Phrases of one block: the first place of each goes on, later ones are marked."""
    block = Block(table)
    number = table["block"][0].as_py()
    half = (length - TRIGGER) // 2
    got = []
    for at, rolling, hashes, first, last, trigger in phrases(block.data, block.offsets, length):
        before = np.where(trigger - first >= half, rolling.of(np.maximum(trigger - half, 0), trigger), 0)
        reach = np.minimum(trigger + length - half + 1, len(rolling.sums) - 1)
        after = np.where(trigger - last < half, rolling.of(trigger, reach), 0)
        got.append([hashes[trigger], rolling.of(first, last + length),
                    np.where(trigger - first >= half, (before & np.uint64(0xFFFF)) | np.uint64(1), 0).astype(np.uint16),
                    np.where(trigger - last < half, (after & np.uint64(0xFFFF)) | np.uint64(1), 0).astype(np.uint16),
                    at + first, (last - first + 1).astype(np.uint8), (trigger - first).astype(np.uint8)])
    out = _nothing(_PHRASES)
    if got:
        trigger, phrase, before, after, place, count, back = map(np.concatenate, zip(*got, strict=True))
        order = np.lexsort((place, phrase, trigger))
        t, p = trigger[order], phrase[order]
        again = np.zeros(len(order), bool)
        again[order] = np.r_[False, (t[1:] == t[:-1]) & (p[1:] == p[:-1])]
        if again.any():
            _add(out, number % buckets, 1, number, place=place[again], count=count[again])
        new = ~again
        deal = (trigger[new] % np.uint64(buckets)).astype(np.int64)
        columns = [trigger, phrase, before, after, *block.ranked(place), count, back]
        names = ["trigger", "phrase", "before", "after", "id", "place", "count", "back"]
        for bucket, values in cut_by(deal, [c[new] for c in columns]):
            _add(out, bucket, 0, number, **dict(zip(names, values, strict=True)))
    return _arrow(out, _PHRASES)


def _add(out: dict[str, list], bucket: int | None, kind: int, block: int, **values: np.ndarray) -> None:
    for name, column in out.items():
        if name in ("bucket", "kind", "block"):
            column.append({"bucket": bucket, "kind": kind, "block": block}[name])
        elif name in ("id", "place"):
            column.append(thin(values[name]) if name in values else b"")
        else:
            column.append(values[name].tobytes() if name in values else b"")


def _passed_on(table: pa.Table, out: dict[str, list]) -> pa.Table:
    """Marks that blocks made themselves go through; what is left is still to be ordered."""
    done = table.filter(pc.equal(table["kind"], 1))
    for name in ("block", "kind", "place", "count"):
        out[name] += done[name].to_pylist()
    return table.filter(pc.equal(table["kind"], 0))


def _marked(out: dict[str, list], kind: int, block: np.ndarray, place: np.ndarray, count: np.ndarray) -> None:
    order = np.argsort(place, kind="stable")
    for number, (p, c) in cut_by(block[order], [place[order], count[order]]):
        _add(out, None, kind, number, place=p, count=c)


def _dictionary(table: pa.Table, length: int) -> pa.Table:
    """Order the phrases of some triggers: mark all places but the first, open phrases that share a part."""
    out = _nothing(_MARKS)
    table = _passed_on(table, out)
    if not table.num_rows:
        return _arrow(out, _MARKS)
    half = (length - TRIGGER) // 2
    trigger, sizes = joined(table["trigger"], np.uint64)
    block = np.repeat(table["block"].to_numpy(), sizes)
    phrase, ids, place = joined(table["phrase"], np.uint64)[0], wide(table["id"])[0], wide(table["place"])[0]
    before, after = joined(table["before"], np.uint16)[0], joined(table["after"], np.uint16)[0]
    count, back = joined(table["count"], np.uint8)[0], joined(table["back"], np.uint8)[0]

    order = np.lexsort((place, ids, phrase, trigger))
    t, p = trigger[order], phrase[order]
    again = np.r_[False, (t[1:] == t[:-1]) & (p[1:] == p[:-1])]
    later = order[again]
    _marked(out, 1, block[later], place[later], count[later])

    first = order[~again]
    # strings that reach `half` bytes or more before the trigger, and the others
    for side, reaching in ((before, True), (after, False)):
        some = first[side[first] > 0]
        rank = some[np.lexsort((side[some], trigger[some]))]
        same = np.r_[False, (trigger[rank][1:] == trigger[rank][:-1]) & (side[rank][1:] == side[rank][:-1])]
        opened = rank[same | np.r_[same[1:], False]] if len(rank) else rank
        lead = back[opened].astype(np.int64)
        many = count[opened].astype(np.int64)
        split = np.clip(lead - half + 1, 0, many)  # so many strings reach that far
        begin = place[opened] + (0 if reaching else split)
        size = split if reaching else many - split
        keep = size > 0
        _marked(out, 2, block[opened][keep], begin[keep], size[keep].astype(np.uint8))
    return _arrow(out, _MARKS)


def _spots(marks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block's bytes, and how many strings begin there in a row."""
    return wide(marks["place"])[0] & ((1 << _SPLIT) - 1), joined(marks["count"], np.uint8)[0].astype(np.int64)


def _runs(keys: np.ndarray, *ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by key, then by the ranks (the last counts least), and what in it repeats the key before."""
    words = keys.view(np.uint32).reshape(-1, 3)
    order = np.lexsort((*ranks[::-1], words[:, 2], words[:, 1], words[:, 0]))
    ranked = words[order]
    return order, np.r_[False, (ranked[1:] == ranked[:-1]).all(1)] if len(order) else np.zeros(0, bool)


def _open(docs: pa.Table, marks: pa.Table, length: int, buckets: int) -> pa.Table:
    """The strings of opened phrases, by content; of a block's equal ones only the first goes on."""
    out = _nothing(_STRINGS)
    if docs.num_rows and marks.num_rows:
        block, number = Block(docs), docs["block"][0].as_py()
        begin, many = _spots(marks)
        spots = np.unique(np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum()))
        if len(spots):
            data = block.data.tobytes()
            digest = xxhash.xxh3_128_digest
            keys = np.frombuffer(b"".join([digest(data[p : p + length])[:_STRING] for p in spots.tolist()]), "V12")
            order, again = _runs(keys, spots)
            again[order] = again.copy()
            one = np.ones(len(spots), np.uint8)
            if again.any():
                _add(out, number % buckets, 1, number, place=spots[again], count=one[again])
            new = ~again
            deal = keys[new].view(np.uint32)[::3] % np.uint32(buckets)
            for bucket, (key, ids, place) in cut_by(deal, [keys[new], *block.ranked(spots[new])]):
                _add(out, bucket, 0, number, string=key, id=ids, place=place)
    return _arrow(out, _STRINGS)


def _ordered(table: pa.Table) -> pa.Table:
    """Mark all but the first of equal strings."""
    out = _nothing(_MARKS)
    table = _passed_on(table, out)
    if table.num_rows:
        keys, sizes = joined(table["string"], "V12")
        block = np.repeat(table["block"].to_numpy(), sizes)
        ids, place = wide(table["id"])[0], wide(table["place"])[0]
        order, again = _runs(keys, ids, place)
        later = order[again]
        _marked(out, 1, block[later], place[later], np.ones(len(later), np.uint8))
    return _arrow(out, _MARKS)


def _cut(docs: pa.Table, marks: pa.Table, length: int) -> pa.Table:
    """Each document without its marked bytes."""
    block = Block(docs)
    begin, many = _spots(marks)
    bounds = np.zeros(len(block.data) + 1, np.int64)
    np.add.at(bounds, begin, 1)
    np.add.at(bounds, begin + many - 1 + length, -1)
    gone = np.cumsum(bounds[:-1]) > 0
    total = np.r_[0, np.cumsum(gone)]
    offsets = block.offsets
    removed = total[offsets[1:]] - total[offsets[:-1]]
    opens = gone & ~np.r_[False, gone[:-1]]
    opens[offsets[:-1][offsets[:-1] < len(gone)]] = gone[offsets[:-1][offsets[:-1] < len(gone)]]
    spans = np.r_[0, np.cumsum(opens)]
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(removed),
        [None, pa.py_buffer((offsets - total[offsets]).astype(np.int64)), pa.py_buffer(block.data[~gone].tobytes())])
    return pa.table({
        "id": block.table["id"], "rest": block.table["rest"], "kept": kept.cast(pa.binary()),
        "n_bytes": np.diff(offsets), "n_removed": removed, "n_spans": spans[offsets[1:]] - spans[offsets[:-1]]})


def in_blocks(docs: DataFrame, doc_id: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """``block, id, split, text, rest``, and how many blocks there are of about ``block_bytes``.

    A block holds whole ids. Of an id (or NULL) whose rows have more bytes than a
    block, each row goes to one of several splits, which count as parts of the id in
    order and lie in blocks of their own.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), rest.alias("rest"))
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
    sizes = stage(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")))
    parts = parts_for(docs, sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0], block_bytes)
    large = stage(sizes.filter((F.col("n") > 1) & (F.col("bytes") > block_bytes)).select(
        F.col("id").alias("of"), F.ceil(F.col("bytes") / block_bytes).alias("splits")))
    split = F.lit(0)
    if not large.isEmpty():
        rows = rows.withColumn("row", F.monotonically_increasing_id()).join(large, F.col("id").eqNullSafe(F.col("of")), "left")
        split = F.coalesce(F.pmod(F.xxhash64("text", "row"), F.col("splits")).cast("int"), F.lit(0))
    rows = rows.select("id", split.alias("split"), "text", "rest")
    block = F.pmod(F.xxhash64("id", "split"), F.lit(parts)).cast("int")
    return rows.select(block.alias("block"), "id", "split", "text", "rest"), parts


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, block_bytes: int = 4 << 20,
) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also starts earlier in the corpus.

    Earlier means a smaller id, or the same document and a smaller position;
    strings never cross documents and are judged on the input. Returns
    ``id, rest`` (a struct of the other columns), ``kept`` (the remaining bytes),
    ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed runs).

    A NULL text is empty. Rows without an id come after all others; rows that
    repeat an id follow each other in the order of their texts (within each split
    of an id that fills more than a block), so of equal rows one stays whole. Texts shorter than ``length`` bytes stay whole, an
    empty table gives an empty one, and columns of any name may be present.
    ``length`` lies between 64 and 255.
    """
    if not 2 * TRIGGER <= length <= 255:
        raise ValueError("length must lie between 64 and 255")
    rows, parts = in_blocks(docs, doc_id, text, block_bytes)
    blocks = rows.repartition(parts, "block")
    # the one exchange of texts serves all three passes over them
    phrases_ = blocks.groupBy("block").applyInArrow(lambda t: _trimmed(_parse(t, length, parts)), _PHRASES)
    marks = phrases_.groupBy("bucket").applyInArrow(lambda t: _trimmed(_dictionary(t, length)), _MARKS)
    strings = blocks.groupBy("block").cogroup(marks.filter("kind = 2").groupBy("block")).applyInArrow(
        lambda d, m: _trimmed(_open(d, m, length, parts)), _STRINGS)
    found = strings.groupBy("bucket").applyInArrow(lambda t: _trimmed(_ordered(t)), _MARKS)
    repeats = marks.filter("kind = 1").unionByName(found)
    kept = f"id long, rest {rest_type(blocks)}, kept binary, n_bytes long, n_removed long, n_spans long"
    return blocks.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(
        lambda d, m: _trimmed(_cut(d, m, length)), kept)


def _trimmed(table: pa.Table) -> pa.Table:
    trim()
    return table


def rest_type(blocks: DataFrame) -> str:
    return blocks.schema["rest"].dataType.simpleString()
