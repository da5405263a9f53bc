"""Terms of rows, taken apart once and kept as dictionaries of parts, so that a term is sent once a part and not once a row.

A part is some thousand rows: its distinct terms, and for each the rows that have
it. The terms are dealt to buckets by a hash, in which they are counted or looked
up exactly, as strings; what is found goes back to the part, which knows its rows.
All of it lies in byte arrays, some thousand terms each, and passes as such.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.session import stage

BUCKETS = 1024
PART_TERMS, PART_BYTES, PART_ROWS = 3_000_000, 1 << 26, 1 << 16  # a row of a part is numbered in 16 bits
_AT_ONCE = 1_000_000  # entries of a bucket, or of several, counted or looked up together


def _flat(a) -> pa.Array:
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def _strings(lens: np.ndarray, data) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lens), pa.py_buffer(offsets), pa.py_buffer(data))


def _bytes_of(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the strings."""
    terms = pa.concat_arrays([terms]) if terms.offset else terms
    _, offsets, data = terms.buffers()
    at = np.frombuffer(offsets, np.int32, len(terms) + 1)
    return at, np.frombuffer(data, np.uint8, at[-1]) if at[-1] else np.empty(0, np.uint8)


def _bucket(terms: pa.Array) -> np.ndarray:
    """A number below ``BUCKETS`` from the length and the first, middle and last eight bytes."""
    at, data = _bytes_of(terms)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    start, size = at[:-1].astype(np.int64), np.diff(at).astype(np.int64)
    short = size < 8
    used = np.where(short, size, 8).astype(np.uint64) * np.uint64(8)
    h = eight[start] & np.where(short, (np.uint64(1) << (used & np.uint64(63))) - np.uint64(1), ~np.uint64(0))
    h = (h ^ size.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    for where in (start + (size - 8) // 2, start + size - 8):
        h = (h ^ np.where(short, np.uint64(0), eight[np.where(short, 0, where)])) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return (h >> np.uint64(8)).astype(np.int64) % BUCKETS


def _blobs(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """A byte array of ``values`` for each pair of neighbouring offsets."""
    at = (offsets * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _by_bucket(terms: pa.Array) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """The terms' order by bucket, the bounds of the buckets in it, and their lengths and bytes as blobs."""
    bucket = _bucket(terms)
    order = np.argsort(bucket.astype(np.uint16), kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))])
    at, data = _bytes_of(terms.take(pa.array(order)))
    return order, bounds, [_blobs(bounds, np.diff(at).astype(np.int32)), _blobs(at[bounds], data)]


def _table(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def first_of(held: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal values."""
    return np.concatenate([[True], held[1:] != held[:-1]]) if len(held) else np.empty(0, bool)


def _distinct(held: np.ndarray) -> np.ndarray:
    held = np.sort(held)  # ten times as fast as np.unique, which hashes
    return held[first_of(held)]


def _with_pairs(words: pa.Array, at: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words and the pairs of neighbours in a row, joined by a space, and each once for each row that has it."""
    near = rows[1:] == rows[:-1]
    pairs = (at[:-1] * len(words) + at[1:])[near]
    if len(words) > 1 << 23:  # a pair and a row would not fit in 63 bits
        found, pairs = np.unique(pairs, return_inverse=True)
    else:
        found = None
    single = _distinct((at << 16) | rows)
    double = _distinct((pairs << 16) | rows[1:][near])
    number = double >> 16
    new = first_of(number)
    which = number[new] if found is None else found[number[new]]
    joined = pc.binary_join_element_wise(words.take(pa.array(which // len(words))), words.take(pa.array(which % len(words))), " ")
    places = np.concatenate([single >> 16, len(words) - 1 + np.cumsum(new)])
    return pa.concat_arrays([words, _flat(joined)]), places, np.concatenate([single, double]) & 0xFFFF


def _part(number: int, keys: list, sizes: list, terms: list, pairs: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = pa.concat_arrays(keys)
    yield _table([pa.array([number]), pa.array([-1]), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                  *[pa.nulls(1)] * 4], schema)
    coded = pa.concat_arrays(terms).dictionary_encode()
    if not len(coded):
        return
    terms, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(held)), np.concatenate(sizes))
    if pairs:
        terms, at, rows = _with_pairs(terms, at, rows)
    order, bounds, blobs = _by_bucket(terms)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    posts = np.sort((place[at] << 16) | rows)
    counts = np.bincount(place[at], minlength=len(order)).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    out = pa.table([pa.nulls(BUCKETS, schema.field("keys").type), *blobs, _blobs(bounds, counts), _blobs(ends[bounds], (posts & 0xFFFF).astype(np.uint16))],
                   names=["keys", "lens", "data", "counts", "posts"])
    used = np.flatnonzero(np.diff(bounds))
    out = out.take(pa.array(used)).combine_chunks()
    yield _table([pa.array(np.full(len(used), number)), pa.array(used), *[_flat(c) for c in out.columns]], schema)


def postings(df: DataFrame, terms: Column, key: str | Column, pairs: bool = False) -> DataFrame:
    """The rows' terms by part and bucket. Stored. A row's terms should be distinct, and none NULL.

    With ``pairs`` they are words in the order of a text, without spaces, and
    the terms are the distinct ones and the distinct pairs of neighbours.

    ``part, bucket, keys, lens, data, counts, posts``: the row of bucket -1 has the
    keys of the part's rows, the others the terms of a bucket (lengths and bytes), in
    how many rows each is, and which.
    """
    key = F.col(key) if isinstance(key, str) else key
    df = df.select(key.alias("key"), terms.alias("terms"))
    fields = [T.StructField("part", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("keys", T.ArrayType(df.schema["key"].dataType)),
              *[T.StructField(n, T.BinaryType()) for n in ("lens", "data", "counts", "posts")]]

    most = PART_TERMS // 2 if pairs else PART_TERMS

    def deal(batches):
        number, keys, sizes, held, count, room, rows = TaskContext.get().partitionId() << 24, [], [], [], 0, 0, 0
        schema = None
        for batch in batches:
            k, t = _flat(batch.column(0)), _flat(batch.column(1))
            schema = schema or pa.schema([("part", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(k.type)), *[(n, pa.binary()) for n in ("lens", "data", "counts", "posts")]])
            size = pc.fill_null(pc.list_value_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # pieces of a batch that fill a part by their terms or their rows
            piece, i = (np.cumsum(size) - size) // most, 0
            while i < len(size):
                j = min(int(np.searchsorted(piece, piece[i], "right")), i + PART_ROWS)
                n, values = int(size[i:j].sum()), t.slice(i, j - i).flatten().cast(pa.string())
                length = int(pc.sum(pc.binary_length(values)).as_py() or 0)
                if rows and (rows + j - i > PART_ROWS or count + n > most or room + length > PART_BYTES):
                    yield from _part(number, keys, sizes, held, pairs, schema)
                    number, keys, sizes, held, count, room, rows = number + 1, [], [], [], 0, 0, 0
                keys.append(k.slice(i, j - i))
                sizes.append(size[i:j])
                held.append(values)
                count, room, rows, i = count + n, room + length, rows + j - i, j
        if rows:
            yield from _part(number, keys, sizes, held, pairs, schema)

    return stage(df.mapInArrow(deal, T.StructType(fields)))


def row_count(parts: DataFrame) -> int:
    return parts.filter("bucket = -1").agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]


def _runs(batches, enough: int | None = None) -> Iterator[list[dict]]:
    """Rows of a bucket, or of some buckets of ``enough`` entries together; the rows come ordered by bucket."""
    run, entries = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if run and row["bucket"] != run[-1]["bucket"] and (enough is None or entries >= enough):
                yield run
                run, entries = [], 0
            run.append(row)
            entries += len(row["lens"]) // 4
    if run:
        yield run


def _terms(rows: list[dict]) -> pa.Array:
    return _strings(np.frombuffer(b"".join(r["lens"] for r in rows), np.int32), b"".join(r["data"] for r in rows))


def count_terms(parts: DataFrame, least: int, most: float) -> DataFrame:
    """``term, docs``: the terms in at least ``least`` and at most ``most`` rows."""

    def count(batches):
        for run in _runs(batches, _AT_ONCE):
            coded = _terms(run).dictionary_encode()
            times = np.frombuffer(b"".join(r["counts"] for r in run), np.int32)
            docs = np.bincount(coded.indices.to_numpy(), times, len(coded.dictionary)).astype(np.int64)
            held = pa.array((docs >= least) & (docs <= most))
            yield pa.RecordBatch.from_arrays([coded.dictionary.filter(held), pa.array(docs).filter(held)], names=["term", "docs"])

    dealt = parts.filter("bucket >= 0").select("bucket", "lens", "data", "counts").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, "term string, docs long")


def _table_blobs(table: DataFrame, values: list[str]) -> DataFrame:
    """Terms of a table by bucket, with their values, as parts of number -1."""

    def deal(batches):
        held, rows = [], 0

        def out():
            t = pa.Table.from_batches(held)
            order, bounds, blobs = _by_bucket(_flat(t.column(0)).cast(pa.string()))
            more = [_blobs(bounds, _flat(t.column(v)).to_numpy(zero_copy_only=False)[order]) for v in values]
            made = pa.table([pa.array(np.full(BUCKETS, -1)), pa.array(np.arange(BUCKETS, dtype=np.int32)), *blobs, *more], names=["part", "bucket", "lens", "data", *values])
            yield from made.take(pa.array(np.flatnonzero(np.diff(bounds)))).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= _AT_ONCE:
                yield from out()
                held, rows = [], 0
        if rows:
            yield from out()

    return table.select("term", *values).mapInArrow(deal, "part long, bucket int, lens binary, data binary, " + ", ".join(f"{v} binary" for v in values))


def _looked_up(parts: DataFrame, table: DataFrame, values: list[str], found, schema: str, *more: str) -> DataFrame:
    """``found`` of the rows of a bucket that has terms of the table: the parts' rows, each term's place in the table or -1, and the table's values."""
    kinds = [np.dtype(np.float64) if isinstance(table.schema[v].dataType, T.DoubleType) else np.dtype(np.int64) for v in values]
    none = [F.lit(None).cast("binary").alias(m) for m in more]
    both = parts.filter("bucket >= 0").select("bucket", "part", "lens", "data", *more, *[F.lit(None).cast("binary").alias(v) for v in values]).unionByName(
        _table_blobs(table, values).select("*", *none))

    def look(batches):
        for run in _runs(batches, _AT_ONCE):
            known, rows = [r for r in run if r["part"] < 0], [r for r in run if r["part"] >= 0]
            if known and rows:
                at = pc.fill_null(pc.index_in(_terms(rows), value_set=_terms(known)), -1).to_numpy()
                yield from found(rows, at, [np.frombuffer(b"".join(r[v] for r in known), k) for v, k in zip(values, kinds, strict=True)])

    return both.repartition("bucket").sortWithinPartitions("bucket", "part").mapInArrow(look, schema)


def look_up_blocks(parts: DataFrame, index: DataFrame, found, schema: str, *more: str) -> DataFrame:
    """``found`` for each bucket, or some, that has terms of the index: rows of the parts with ``more``, places in the index's codes, the codes."""
    return _looked_up(parts, index.select("term", "code"), ["code"], found, schema, *more)


def look_up(parts: DataFrame, table: DataFrame, key: str, *values: str) -> DataFrame:
    """``key`` and the ``values`` of the table (long or double), a row for each term of each row that is in its column ``term``."""
    values = list(values)
    kinds = [np.dtype(np.float64) if isinstance(table.schema[v].dataType, T.DoubleType) else np.dtype(np.int64) for v in values]
    table = table.select("term", *[F.col(v) if isinstance(table.schema[v].dataType, T.DoubleType) else F.col(v).cast("long").alias(v) for v in values])

    def found(rows, at, columns):
        out, i = {n: [] for n in ("part", "bucket", "hit", *values)}, 0
        for r in rows:
            n = len(r["lens"]) // 4
            mine, i = at[i:i + n], i + n
            hit = mine >= 0
            if hit.any():
                out["part"].append(r["part"])
                out["bucket"].append(r["bucket"])
                out["hit"].append(np.packbits(hit).tobytes())
                for v, c in zip(values, columns, strict=True):
                    out[v].append(c[mine[hit]].tobytes())
        if out["part"]:
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("part", pa.int64()), ("bucket", pa.int32()), *[(n, pa.binary()) for n in ("hit", *values)]]))

    kept = ", ".join(f"{v} binary" for v in values)
    hits = _looked_up(parts, table, values, found, f"part long, bucket int, hit binary, {kept}")
    back = parts.select("part", "bucket", "keys", "counts", "posts").unionByName(hits, allowMissingColumns=True)
    key_type = parts.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField(key, key_type), *[table.schema[v] for v in values]])

    def rows_of(batches):
        keys, part, waiting, rows, columns, size = None, None, None, [], [[] for _ in values], 0

        def out():
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(np.concatenate(rows))), *[pa.array(np.concatenate(c)) for c in columns]], names=[key, *values])

        for batch in batches:
            lists = _flat(batch.column(batch.schema.get_field_index("keys")))
            for i, r in enumerate(batch.drop_columns(["keys"]).to_pylist()):
                if r["bucket"] < 0:
                    if size:
                        yield from out()
                        rows, columns, size = [], [[] for _ in values], 0
                    keys, part, waiting = lists[i].values, r["part"], None
                    continue
                if waiting is None or waiting["bucket"] != r["bucket"] or waiting["part"] != r["part"]:
                    waiting = r
                    continue
                a, b = (r, waiting) if r["hit"] is not None else (waiting, r)
                counts = np.frombuffer(b["counts"], np.int32)
                hit = np.unpackbits(np.frombuffer(a["hit"], np.uint8), count=len(counts)).astype(bool)
                rows.append(np.frombuffer(b["posts"], np.uint16)[np.repeat(hit, counts)])
                for c, v, k in zip(columns, values, kinds, strict=True):
                    c.append(np.repeat(np.frombuffer(a[v], k), counts[hit]))
                size += len(rows[-1])
                if size >= 100_000:
                    yield from out()
                    rows, columns, size = [], [[] for _ in values], 0
        if size:
            yield from out()

    return back.repartition("part").sortWithinPartitions("part", "bucket").mapInArrow(rows_of, schema)
