"""Language-model scores by a weighted backoff automaton over word pairs.

The states are the words seen in training, and a root. A word that followed a
state's word in training has an arc there; any other word takes the failure
arc to the root, whose arcs reach every word. Counts are smoothed towards the
root with weight ``mu``: an arc weighs ``(pair + mu * root) / (state + mu)``,
the failure arc ``mu / (state + mu)``, so every state's arcs sum to one. A text
is read once from left to right, the state carried along, the logarithms added
up.

No task ever holds the model. Documents are read in blocks; a block's sorted
distinct words and pairs go to buckets by hash, packed; a bucket adds the
counts up and answers each block with the entries that other blocks have too.
So a block knows all arcs that its own texts can take, and no others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import (
    RollingHash,
    block_of,
    cut_by,
    flat,
    joined,
    mixed,
    parts_for,
    text_size,
    thin,
    utf8,
    wide,
)

END = np.uint64(0x51ED270B6A3C1F27)  # the hash of a text's end
SLICE = 1 << 20
_WORDS, _PAIRS = 0, 1
_ENTRIES = "bucket int, block int, kind int, hash binary, count binary"
_ANSWERS = "block int, bucket int, kind int, item binary, count binary"
_SUMS = "tokens long, words long"
_SCORES = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Stream:
    """The tokens of some texts, end to end: the hash of each, and where each text's tokens begin."""

    def __init__(self, texts: pa.ChunkedArray):
        data, offsets = utf8(texts)
        blank = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = np.flatnonzero(~blank & (np.r_[True, blank[:-1]] | edge[:-1])) if len(data) else np.zeros(0, int)
        last = np.flatnonzero(~blank & (np.r_[blank[1:], True] | edge[1:])) + 1 if len(data) else np.zeros(0, int)
        doc = np.searchsorted(offsets, first, side="right") - 1
        words = np.bincount(doc, minlength=len(offsets) - 1)
        self.starts = np.cumsum(words + 1) - words - 1  # each text has an end token too
        self.sizes = words + 1
        self.hash = np.full(len(first) + len(words), END, np.uint64)
        at = 0
        while at < len(first):  # a stretch of bytes at a time
            to = max(at + 1, int(np.searchsorted(last, first[at] + SLICE, side="right")))
            rolling = RollingHash(_LOWER[data[first[at] : last[to - 1]]])
            self.hash[np.arange(at, to) + doc[at:to]] = rolling.of(first[at:to] - first[at], last[at:to] - first[at])
            at = to
        # a text is read from the end of the one before, so its first state is that of an end
        before = np.r_[END, self.hash[:-1]] if len(self.hash) else self.hash
        self.pair = mixed(before * np.uint64(0xC2B2AE3D27D4EB4F) + self.hash)

    def per_token(self, of_doc: np.ndarray) -> np.ndarray:
        return np.repeat(of_doc, self.sizes)

    def per_doc(self, of_token: np.ndarray) -> np.ndarray:
        return np.add.reduceat(of_token, self.starts) if len(self.starts) else of_token


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted entries lie close together."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _distinct(hashes: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, at = np.unique(hashes, return_inverse=True)
    return values, at, np.bincount(at, weights=learned, minlength=len(values)).astype(np.int64)


def _lists(columns: list[str]) -> dict[str, list]:
    return {c.split()[0]: [] for c in columns}


def _table(rows: dict[str, list], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table({name: pa.array(rows[name], kinds[kind]) for name, kind in (p.split() for p in schema.split(","))})


def _vocabulary(frame, buckets: int):
    """Words learned from a batch of texts, by bucket."""
    for batch in frame:
        rows = _lists(_ENTRIES.split(","))
        texts = pa.Table.from_batches([batch.filter(batch["learned"])])
        values, _, count = _distinct(hashes := Stream(texts["text"]).hash, np.ones(len(hashes)))
        for bucket, (h, c) in cut_by(_bucket(values, buckets), [values, count]):
            for name, cell in zip(rows, (bucket, 0, _WORDS, thin(h.view(np.int64)), thin(c, False)), strict=True):
                rows[name].append(cell)
        yield from _table(rows, _ENTRIES).to_batches()


def _vocabulary_sums(table: pa.Table) -> pa.Table:
    hashes, counts = wide(table["hash"])[0], wide(table["count"], False)[0]
    return pa.table({"tokens": pa.array([int(counts.sum())], pa.int64()),
                     "words": pa.array([len(np.unique(hashes))], pa.int64())})


def _entries(table: pa.Table, buckets: int) -> pa.Table:
    """A block's distinct words and pairs with their counts in training texts."""
    stream, block = Stream(table["text"]), table["block"][0].as_py()
    learned = stream.per_token(flat(table["learned"]).to_numpy(zero_copy_only=False))
    rows = _lists(_ENTRIES.split(","))
    for kind, hashes in ((_WORDS, stream.hash), (_PAIRS, stream.pair)):
        values, _, count = _distinct(hashes, learned)
        for bucket, (h, c) in cut_by(_bucket(values, buckets), [values, count]):
            for name, cell in zip(rows, (bucket, block, kind, thin(h.view(np.int64)), thin(c, False)), strict=True):
                rows[name].append(cell)
    return _table(rows, _ENTRIES)


def _answers(table: pa.Table) -> pa.Table:
    """Total counts of what several blocks hold, told to each by its own entries' numbers."""
    rows = _lists(_ANSWERS.split(","))
    kinds, bucket = table["kind"].to_numpy(), table["bucket"][0].as_py()
    for kind in (_WORDS, _PAIRS):
        part = table.filter(pa.array(kinds == kind))
        if not part.num_rows:
            continue
        hashes, sizes = wide(part["hash"])
        counts = wide(part["count"], False)[0]
        block = np.repeat(part["block"].to_numpy(), sizes)
        item = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        _, at, blocks = np.unique(hashes, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=counts).astype(np.int64)
        told = (blocks[at] > 1) & (total[at] != counts)
        for number, (i, c) in cut_by(block[told], [item[told], total[at][told]]):
            for name, cell in zip(rows, (number, bucket, kind, thin(i), thin(c, False)), strict=True):
                rows[name].append(cell)
    return _table(rows, _ANSWERS)


def _told(kind: int, values: np.ndarray, count: np.ndarray, answers: pa.Table, buckets: int) -> np.ndarray:
    """The block's counts with what other blocks add."""
    count = count.copy()
    part = answers.filter(pa.array(answers["kind"].to_numpy() == kind))
    if part.num_rows:
        first = np.searchsorted(_bucket(values, buckets), part["bucket"].to_numpy().astype(np.uint64))
        items, sizes = wide(part["item"])
        count[np.repeat(first, sizes) + items] = wide(part["count"], False)[0]
    return count


def _scores(docs: pa.Table, answers: pa.Table, buckets: int, tokens: int, words: int, mu: float) -> pa.Table:
    stream = Stream(docs["text"])
    learned = stream.per_token(flat(docs["learned"]).to_numpy(zero_copy_only=False))
    values, word, own = _distinct(stream.hash, learned)
    known = _told(_WORDS, values, own, answers, buckets)
    pairs, arc, own = _distinct(stream.pair, learned)
    followed = _told(_PAIRS, pairs, own, answers, buckets)

    root = (known + 1) / (tokens + words + 1)  # of each word: its arc at the root
    ends = known[np.searchsorted(values, END)] if len(values) else 0
    state = np.r_[ends, known[word][:-1]] if len(word) else known  # the count of the state's word
    taken, root_of = followed[arc], root[word]
    # the arc where there is one, else the failure arc and the root's
    step = np.where(taken > 0, np.log10((taken + mu * root_of) / (state + mu)),
                    np.log10(mu / (state + mu)) + np.log10(root_of))
    return pa.table({
        "id": docs["id"], "held_out": docs["held_out"], "n_tokens": stream.sizes.astype(np.int64),
        "n_known": stream.per_doc((known[word] > 0).astype(np.int64)),
        "base_score": stream.per_doc(np.log10(root_of)), "score": stream.per_doc(step)})


def score(
    docs: DataFrame, learned, held_out, doc_id: str = "doc_id", text: str = "text", mu: float = 300.0,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """Score each text by a model of the texts where ``learned`` holds.

    Returns ``id, held_out, n_tokens, n_known`` (tokens seen in training),
    ``base_score`` (add-one unigrams), ``score`` (the automaton's log10
    probability) and ``train_tokens``. Words are cut at white space, A-Z in
    lower case; each text ends with an end token, counted as a token.

    A NULL or empty text is the end token alone. A NULL condition counts as
    false. With nothing to learn from all scores are 0. Rows that repeat an id
    are scored each; an empty table gives an empty one; other columns are not
    looked at. Words are told apart by 64-bit hashes.
    """
    parts = parts_for(docs, text_size(docs, text), block_bytes)
    rows = docs.select(
        block_of(F.struct(doc_id, F.octet_length(text)), parts).alias("block"), F.col(doc_id).cast("long").alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(learned, F.lit(False)).alias("learned"),
        F.col(text).alias("text"))
    seen = rows.mapInArrow(lambda frame: _vocabulary(frame, parts), _ENTRIES).groupBy("bucket").applyInArrow(
        _vocabulary_sums, _SUMS)
    tokens, words = (x or 0 for x in seen.agg(F.sum("tokens"), F.sum("words")).first())

    blocks = rows.repartition(parts, "block")  # the texts' one exchange serves counting and scoring
    entries = blocks.groupBy("block").applyInArrow(lambda t: _entries(t, parts), _ENTRIES)
    answers = entries.groupBy("bucket").applyInArrow(_answers, _ANSWERS)
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda d, a: _scores(d, a, parts, tokens, words, mu), _SCORES)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
