"""Ranked lexical search over a K2-treap of the term-document grid.

A shard is a range of documents. Its grid has a row for each term and a column
for each document, in the order of their ids; a filled cell is the impact of a
term on a document's score, apart from the term's weight. The cells are kept as a
compressed quadtree, in which a cell without branching is skipped, and each cell
holds the largest impact under it. To rank documents for an item, the paths of
all its rows go down together: a state is a range of columns with one cell for
each row that still has documents there, and the sum of weights times largest
impacts bounds every score in the range. The states with the highest bounds are
opened first, until none can hold a document as good as the ones already found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import trim, utf8
from rillstone.session import spread, stage

TOTAL = 1_000_000_000  # an impact is TOTAL * tf div (1000 * tf + 8 * m)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
               for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, letters A-Z in lower case, and everything beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


# ---------------------------------------------------------------- the tree of one shard

def interleaved(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The bits of row and column in turns, the row's first."""
    def apart(x):
        x = x.astype(np.uint64)
        for by, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                         (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = (x | (x << np.uint64(by))) & np.uint64(mask)
        return x

    return (apart(row) << np.uint64(1)) | apart(col)


def _log2(x: np.ndarray) -> np.ndarray:
    """Binary digits of each number."""
    n = np.zeros(len(x), np.int64)
    rest = x.copy()
    for by in (32, 16, 8, 4, 2, 1):
        big = rest >> np.uint64(by) > 0
        n[big] += by
        rest[big] >>= np.uint64(by)
    return n + (rest > 0)


class Treap:
    """Cells in levels, each with its largest impact: ``row`` and ``col`` at the cell's ``level``, and its children."""

    FIELDS = (("level", np.uint8), ("row", np.uint32), ("col", np.uint32), ("top", np.int32))

    def __init__(self, level, row, col, top, child):
        self.level, self.row, self.col, self.top, self.child = level, row, col, top, child

    @classmethod
    def of(cls, row: np.ndarray, col: np.ndarray, impact: np.ndarray) -> Treap:
        """The tree of a grid's filled cells, none of them twice; ``child`` has one more entry than there are cells."""
        code = interleaved(row, col)
        order = np.argsort(code, kind="stable")
        code, impact = code[order], impact[order].astype(np.int32)
        n = len(code)
        a, b = np.zeros(min(n, 1), np.int64), np.full(min(n, 1), n, np.int64)
        levels = []
        while len(a):
            level = (_log2(code[a] ^ code[b - 1]) + 1) // 2
            count = np.zeros(len(a), np.int64)
            inner = np.flatnonzero(level)
            cut = np.empty((len(inner), 5), np.int64)
            cut[:, 0], cut[:, 4] = a[inner], b[inner]
            shift = (2 * level[inner]).astype(np.uint64)
            under = (code[a[inner]] >> shift) << shift
            for k in (1, 2, 3):
                cut[:, k] = np.searchsorted(code, under + (np.uint64(k) << (shift - np.uint64(2))))
            here, there = cut[:, :4].ravel(), cut[:, 1:].ravel()
            full = there > here
            count[inner] = full.reshape(-1, 4).sum(axis=1)
            levels.append((a, b, level, count))
            a, b = here[full], there[full]
        if not levels:
            return cls(*[np.zeros(0, t) for _, t in cls.FIELDS], np.ones(1, np.int64))
        a, b, level, count = [np.concatenate(x) for x in zip(*levels, strict=True)]
        child = np.r_[1, 1 + np.cumsum(count)]
        top = impact[a].copy()
        # cells stand level by level, so the children of each come behind it and are done before it
        edge = np.cumsum([0, *[len(x[0]) for x in levels]])
        for k in range(len(levels) - 2, -1, -1):
            at = np.arange(edge[k], edge[k + 1])
            inner = at[count[at] > 0]
            if len(inner):
                top[inner] = np.maximum.reduceat(top[edge[k + 1]:edge[k + 2]], child[inner] - edge[k + 1])
        row, col = row[order][a] >> level.astype(row.dtype), col[order][a] >> level.astype(col.dtype)
        return cls(level.astype(np.uint8), row.astype(np.uint32), col.astype(np.uint32), top, child)

    def _generations(self) -> Iterator[tuple[slice, np.ndarray]]:
        """The cells under the root, generation by generation, and each one's parent."""
        a, b = 0, min(1, len(self.level))
        while a < b:
            size = np.diff(self.child[a:b + 1])
            parent = np.repeat(np.arange(a, b), size)
            a, b = int(self.child[a]), int(self.child[b])
            yield slice(a, b), parent

    def packed(self) -> dict[str, bytes]:
        """Each field against the parent cell's, plane by plane, since high bytes are mostly zero, and compressed."""
        own = {name: getattr(self, name).astype(kind) for name, kind in self.FIELDS}
        for cells, parent in self._generations():
            deeper = self.level[parent] - self.level[cells]
            own["row"][cells] -= self.row[parent] << deeper
            own["col"][cells] -= self.col[parent] << deeper
            own["top"][cells] = self.top[parent] - self.top[cells]
        own["child"] = np.diff(self.child, prepend=0).astype(np.uint8)  # the first entry is 1, others at most 4
        planes = {k: np.ascontiguousarray(v.view(np.uint8).reshape(len(v), v.dtype.itemsize).T) for k, v in own.items()}
        return {k: zstandard.compress(v.tobytes(), 1) for k, v in planes.items()}

    @classmethod
    def unpacked(cls, fields: dict[str, bytes]) -> Treap:
        def read(name, kind):
            planes = np.frombuffer(zstandard.decompress(fields[name]), np.uint8).reshape(np.dtype(kind).itemsize, -1)
            return np.ascontiguousarray(planes.T).view(kind).ravel()

        tree = cls(*[read(name, kind).copy() for name, kind in cls.FIELDS], np.cumsum(read("child", np.uint8).astype(np.int64)))
        for cells, parent in tree._generations():
            deeper = tree.level[parent] - tree.level[cells]
            tree.row[cells] += tree.row[parent] << deeper
            tree.col[cells] += tree.col[parent] << deeper
            tree.top[cells] = tree.top[parent] - tree.top[cells]
        return tree

    def best(self, item: np.ndarray, row: np.ndarray, weight: np.ndarray, floor: np.ndarray, k: int, batch: int = 16):
        """For items with these rows and weights: item, column and score of each one's ``k`` best documents.

        ``floor`` holds for each item the least score that is wanted. Equal
        scores go to the smaller column. Several items go down side by side.
        """
        count, empty = len(floor), np.zeros(0, np.int64)
        found = (empty, empty, empty)
        floor = floor.copy()
        if not len(self.level) or not len(item):
            return found
        high = int(self.level[0])
        on = (row >> high) == self.row[0]
        # the frontier: parts (state, row, weight, cell) in the order of their states
        order = np.argsort(item[on], kind="stable")
        p_row, p_weight = row[on][order], weight[on][order]
        p_cell = np.zeros(len(p_row), np.int64)
        s_item, p_state = np.unique(item[on][order], return_inverse=True)
        s_level, steps = np.full(len(s_item), high, np.int64), 0
        s_col = np.full(len(s_item), int(self.col[0]), np.int64)
        while len(s_item):
            bound = np.add.reduceat(p_weight * self.top[p_cell], np.searchsorted(p_state, np.arange(len(s_item))))
            live = bound >= np.maximum(floor[s_item], 1)
            # the best of each item's states are opened, the others wait
            rank = np.lexsort((s_col << s_level, -bound, s_item))
            rank = rank[live[rank]]
            if not len(rank):
                break
            owner = s_item[rank]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            place = np.arange(len(rank)) - np.repeat(first, np.diff(np.r_[first, len(rank)]))
            chosen = np.zeros(len(s_item), bool)
            chosen[rank[place < batch]] = True
            steps += 1
            if steps > 2 * high or (floor[s_item] > 0).all():
                batch *= 2  # what is left is likely to be opened anyway: in fewer, larger steps
            mine = chosen[p_state]
            q_state, q_row, q_weight, q_cell = p_state[mine], p_row[mine], p_weight[mine], p_cell[mine]
            kept = live & ~chosen
            stay = kept[p_state]
            renumber = np.cumsum(kept) - 1
            rest = (renumber[p_state[stay]], p_row[stay], p_weight[stay], p_cell[stay])
            rest_states = (s_item[kept], s_level[kept], s_col[kept])
            # states all of whose cells are single documents are scored, document by document
            inner = np.bincount(q_state, self.level[q_cell] > 0, len(s_item)) > 0
            flat = ~inner[q_state]
            if flat.any():
                scored = self._scored(s_item[q_state[flat]], self.col[q_cell[flat]], q_weight[flat] * self.top[q_cell[flat]])
                found, floor = _top(found, scored, floor, k, count)
            deep = ~flat
            q_state, q_row, q_weight, q_cell = q_state[deep], q_row[deep], q_weight[deep], q_cell[deep]
            p_state, p_row, p_weight, p_cell, s_item, s_level, s_col = self._opened(
                q_state, q_row, q_weight, q_cell, s_item, s_level, s_col, rest, rest_states)
        return found

    @staticmethod
    def _scored(item, col, part):
        order = np.lexsort((col, item))
        item, col, part = item[order], col[order].astype(np.int64), part[order]
        first = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (col[1:] != col[:-1])])
        return item[first], col[first], np.add.reduceat(part, first)

    def _opened(self, state, row, weight, cell, s_item, s_level, s_col, rest, rest_states):
        """The halves of each state, with the cells that its rows have there, behind the states that wait."""
        level, own = s_level[state] - 1, self.level[cell].astype(np.int64)
        # a cell smaller than its state's half goes on as it is; one as large is replaced by its children
        split = own > level
        keep = ~split
        start, stop = self.child[cell[split]], self.child[cell[split] + 1]
        size = stop - start
        index = np.repeat(np.arange(len(size)), size)
        children = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        take = lambda x: np.r_[x[keep], x[split][index]]
        state, row, weight, level = take(state), take(row), take(weight), take(level)
        cell = np.r_[cell[keep], children]
        on = (row >> self.level[cell]) == self.row[cell]
        state, row, weight, level, cell = state[on], row[on], weight[on], level[on], cell[on]
        col = self.col[cell].astype(np.int64) >> (level - self.level[cell])
        order = np.lexsort((col, state))
        state, row, weight, level, cell, col = (x[order] for x in (state, row, weight, level, cell, col))
        new = np.r_[True, (state[1:] != state[:-1]) | (col[1:] != col[:-1])] if len(state) else np.zeros(0, bool)
        before = len(rest_states[0])
        return (
            np.r_[rest[0], np.cumsum(new) - 1 + before], np.r_[rest[1], row], np.r_[rest[2], weight], np.r_[rest[3], cell],
            np.r_[rest_states[0], s_item[state[new]]], np.r_[rest_states[1], level[new]], np.r_[rest_states[2], col[new]])


def _top(found, scored, floor, k, count):
    """Each item's ``k`` best of both, and the least score that still gets in."""
    item, col, score = (np.concatenate(x) for x in zip(found, scored, strict=True))
    order = np.lexsort((col, -score, item))
    item, col, score = item[order], col[order], score[order]
    first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    place = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
    last = place == k - 1
    floor = floor.copy()
    floor[item[last]] = np.maximum(floor[item[last]], score[last])
    best = place < k
    return (item[best], col[best], score[best]), floor


# ---------------------------------------------------------------- the index

_INDEX = ("shard long, docs array<long>, terms binary, df binary, "
          "level binary, row binary, col binary, top binary, child binary")


def totals(docs: DataFrame, text: str) -> tuple[int, int]:
    """Documents that hold a term, and terms of all documents, repeats included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.frombuffer(_LOWER, np.uint8) != 0x20
        for batch in batches:
            held = words = 0
            for a in range(0, batch.num_rows, 64):
                data, offsets = utf8(batch.column(0).slice(a, 64))
                begins = np.diff(inside[data].view(np.int8), prepend=np.int8(0)) > 0
                starts = offsets[:-1][offsets[:-1] < len(data)]
                begins[starts] = inside[data[starts]]  # a text's first byte follows nothing
                at = np.searchsorted(np.flatnonzero(begins), offsets)
                held, words = held + int((np.diff(at) > 0).sum()), words + int(at[-1])
            yield pa.RecordBatch.from_pydict({"held": pa.array([held]), "n": pa.array([words])})

    sums = spread(docs.select(text)).mapInArrow(count, "held long, n long").agg(F.sum("held"), F.sum("n")).first()
    return sums[0] or 0, sums[1] or 0


def _shard(number: int, docs: list, counts: list[Counter], total: tuple[int, int]) -> pa.RecordBatch:
    order = sorted(range(len(docs)), key=lambda i: (docs[i] is None, docs[i] or 0))
    vocabulary = sorted(set().union(*counts))
    row_of = {t: i for i, t in enumerate(vocabulary)}
    sizes = np.array([len(counts[i]) for i in order], np.int64)
    row = np.fromiter((row_of[t] for i in order for t in counts[i]), np.int64, sizes.sum())
    tf = np.fromiter((n for i in order for n in counts[i].values()), np.int64, sizes.sum())
    # a document's length against the mean one
    m = np.array([10 + 90 * counts[i].total() * total[0] // max(total[1], 1) for i in order], np.int64)
    impact = TOTAL * tf // (1000 * tf + 8 * np.repeat(m, sizes))
    tree = Treap.of(row, np.repeat(np.arange(len(order)), sizes), impact)
    df = np.bincount(row, minlength=len(vocabulary)).astype(np.int32)
    columns = {"shard": pa.array([number], pa.int64()), "docs": pa.array([[docs[i] for i in order]], pa.list_(pa.int64())),
               "terms": pa.array([zstandard.compress(b" ".join(vocabulary), 1)], pa.binary()),
               "df": pa.array([zstandard.compress(df.tobytes(), 1)], pa.binary())}
    return pa.RecordBatch.from_pydict(columns | {k: pa.array([v], pa.binary()) for k, v in tree.packed().items()})


def index(docs: DataFrame, doc_id: str, text: str, total: tuple[int, int], each: int) -> DataFrame:
    """One row per shard: its documents, its terms and in how many of them each is, and the tree. Stored.

    A task closes a shard after about ``each`` bytes of text; nothing is shuffled.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, counts, size = [], [], 0
        for batch in batches:
            for doc, words in zip(batch.column("doc").to_pylist(), batch.column("words"), strict=True):
                words = words.as_py()
                found = Counter(terms(words))
                if not found:
                    continue
                ids.append(doc)
                counts.append(found)
                size += len(words)
                if size >= each:
                    yield _shard(number, ids, counts, total)
                    number, ids, counts, size = number + 1, [], [], 0
            del batch
            trim()
        if ids:
            yield _shard(number, ids, counts, total)
        del ids, counts
        trim()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("words"))
    return stage(spread(rows).mapInArrow(build, _INDEX))


def weighed(items: DataFrame, item_id: str, text: str, shards: DataFrame, n: int) -> DataFrame:
    """``item, key, terms, weights``, one row per item: its terms that some document holds. Stored.

    Items that agree in id and text are one; ``key`` tells items apart that share an id.
    """
    @F.arrow_udf("array<binary>")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(terms(t))) for t in texts.to_pylist()], pa.list_(pa.binary()))

    rows = items.select(F.col(item_id).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    rows = rows.select("item", F.xxhash64("text").alias("key"), F.explode(distinct("text")).alias("term"))
    rows = stage(rows)
    def held_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array(zstandard.decompress(words).split(b" "), pa.binary()),
                    "df": pa.array(np.frombuffer(zstandard.decompress(n), np.int32).astype(np.int64))})

    held = shards.select("terms", "df").mapInArrow(held_by, "term binary, df long")
    # partial sums first, so that a term in all shards sends one row per task
    df = stage(held.join(rows.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    pairs = rows.join(df, "term").groupBy("item", "key").agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("all"))
    return stage(pairs.select("item", "key", F.col("all.term").alias("terms"), F.col("all.w").alias("weights")))


def _searched(shards: pa.Table, items: pa.Table, k: int, cells: int = 200_000) -> pa.Table:
    """The best documents of some shards for some items; about ``cells`` filled cells are in work at a time."""
    asked = [x.as_py() for x in items.column("terms")]
    weights = [np.array(x.as_py(), np.int64) for x in items.column("weights")]
    floor = np.zeros(len(asked), np.int64)
    none = np.zeros(0, np.int64)
    found, docs_of = [(none, none, none)], [np.zeros(0, object)]
    for s in range(shards.num_rows):
        shard = {c: shards.column(c)[s].as_py() for c in ("docs", "terms", "df", *[f for f, _ in Treap.FIELDS], "child")}
        row_of = {t: i for i, t in enumerate(zstandard.decompress(shard["terms"]).split(b" "))}
        df = np.frombuffer(zstandard.decompress(shard["df"]), np.int32).astype(np.int64)
        tree = Treap.unpacked(shard)
        rows, own = [], []
        for mine, w in zip(asked, weights, strict=True):
            at = np.array([row_of.get(t, -1) for t in mine], np.int64)
            rows.append(at[at >= 0])
            own.append(w[at >= 0])
        held = np.cumsum([df[r].sum() for r in rows])
        edges = np.flatnonzero(np.diff(held // cells, prepend=0))
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(rows)], strict=True):
            if a == b:
                continue
            item = np.repeat(np.arange(b - a), [len(r) for r in rows[a:b]])
            i, col, score = tree.best(item, np.concatenate(rows[a:b]), np.concatenate(own[a:b]), floor[a:b], k)
            found.append((i + a, col, score))
            docs_of.append(np.array(shard["docs"], object)[col])
        i, score = np.concatenate([f[0] for f in found]), np.concatenate([f[2] for f in found])
        doc = np.concatenate(docs_of)
        # of all shards so far the best; equal scores by id, documents without one last
        known = np.array([d is not None for d in doc], bool)
        order = np.lexsort((np.array([d or 0 for d in doc], np.int64), ~known, -score, i))
        i, score, doc = i[order], score[order], doc[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else none
        place = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
        floor[i[place == k - 1]] = score[place == k - 1]
        best = place < k
        found, docs_of = [(i[best], none, score[best])], [doc[best]]
    trim()
    at = pa.array(found[0][0])
    return pa.table({"item": items.column("item").take(at), "key": items.column("key").take(at),
                     "doc_id": pa.array(docs_of[0].tolist(), pa.int64()), "score": pa.array(found[0][2], pa.int64())})


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", each: int = 4 << 20, block: int = 1024,
) -> DataFrame:
    """Each item's ``k`` highest-scoring documents with a score above 0: ``item_id, rank, doc_id, score``.

    ``each``: bytes of text in a shard; ``block``: items that meet a group of
    shards together, as long as there are more. Equal scores are ranked by
    ascending id; a document without an id comes last among them; rows that
    repeat an id are documents of their own. Items that agree in id and text are
    one item, items that share only the id are ranked apart. A NULL or empty text
    has no term. Other columns are not looked at.
    """
    total = totals(docs, text)
    shards = index(docs, doc_id, text, total, each)
    asked = weighed(items, item_id, item_text, shards, total[0])
    bytes_, count = shards.agg(F.coalesce(F.sum(sum(F.octet_length(f) for f, _ in Treap.FIELDS)), F.lit(0)), F.count("*")).first()
    blocks = -(-asked.count() // block) or 1
    groups = min(max(4 * docs.sparkSession.sparkContext.defaultParallelism, bytes_ // (16 << 20)), max(count, 1))
    number = F.pmod(F.xxhash64("item", "key"), F.lit(blocks)).cast("int")
    asked = asked.withColumn("block", number).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    shards = shards.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    kind = f"item {asked.schema['item'].dataType.simpleString()}, key long, doc_id long, score long"
    found = shards.groupBy("group", "block").cogroup(asked.groupBy("group", "block")).applyInArrow(
        lambda left, right: _searched(left, right, k), kind)
    order = Window.partitionBy("item", "key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
