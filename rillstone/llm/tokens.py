"""Byte-level BPE: encoding in overlapping chunks, decoding, and a memory of encoded words."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import worker_cache


class Words(dict):
    """Encoded words with the blank before them, kept as packed ids.

    Pre-tokens hold at most one blank, in front: a blank with no white space
    behind it always begins one, whatever stands before. So a text may be cut
    there, and equal pieces have equal ids. Words not met yet are encoded
    together; in their ids, each begins at a token that begins with a blank
    (``leads`` tells which do). The memory is emptied once it holds ``most`` words.
    """

    def __init__(self, encode: Callable[[str], list[int]], leads: np.ndarray, most: int = 500_000):
        super().__init__()
        self.encode, self.leads, self.most = encode, leads, most

    def _learn(self, words: list[str]) -> bool:
        """Whether the words could be told apart in their common ids."""
        if any(not w or w[0].isspace() for w in words):
            return False
        ids = np.array(self.encode(" " + " ".join(words)), np.int32)
        starts = np.flatnonzero(self.leads[ids])
        if len(starts) != len(words):
            return False
        packed = ids.tobytes()
        bounds = [*(4 * starts).tolist(), len(packed)]
        for word, a, b in zip(words, bounds[:-1], bounds[1:], strict=True):
            self[word] = packed[a:b]
        return True

    def ids(self, text: str) -> bytes:
        """Ids of a whole text as packed 32-bit integers."""
        head, *rest = text.split(" ")
        fresh = [w for w in dict.fromkeys(rest) if w not in self]
        if fresh and len(self) + len(fresh) > self.most:
            self.clear()
            fresh = list(dict.fromkeys(rest))
        if fresh and not self._learn(fresh):
            return array("i", self.encode(text)).tobytes()
        return array("i", self.encode(head)).tobytes() + b"".join(map(self.__getitem__, rest))


def _read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _leads(tokens: Iterable[tuple[int, bool]]) -> np.ndarray:
    known = dict(tokens)
    out = np.zeros(max(known) + 1, bool)
    out[[i for i, lead in known.items() if lead]] = True
    return out


def rank_words(path: str, pattern: str) -> Words:
    """Words encoded by the ranks of a file, each match of the pattern separately, without special tokens."""
    found = worker_cache("rank_words")
    if (path, pattern) not in found:
        import tiktoken

        ranks = _read_ranks(path)
        bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found[path, pattern] = Words(bpe.encode_ordinary, _leads((i, t[:1] == b" ") for t, i in ranks.items()))
    return found[path, pattern]


def token_bytes(path: str) -> list[bytes]:
    """Each id's bytes."""
    found = worker_cache("token_bytes")
    if path not in found:
        ranks = _read_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        found[path] = table
    return found[path]


def lists(cells: list[bytes]) -> pa.ListArray:
    """Packed ids as lists of integers."""
    offsets = np.zeros(len(cells) + 1, np.int64)
    np.cumsum([len(c) // 4 for c in cells], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(cells))])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def begins(pattern: str) -> Callable[[str], list[int]]:
    """Finds where pre-tokens begin when a scan starts at a text's first character."""
    found = worker_cache("patterns")
    if pattern not in found:
        import regex

        found[pattern] = regex.compile(pattern)
    return lambda text: [m.start() for m in found[pattern].finditer(text)]


def _overlap_begins(text: Column, stride: int, overlap: int, pattern: str) -> Column:
    """For a chunk: pre-token beginnings in its first ``overlap`` characters and in those after its ``stride``."""

    @F.arrow_udf("struct<head: array<int>, tail: array<int>>")
    def find(texts: pa.Array) -> pa.Array:
        scan = begins(pattern)
        heads, tails = [], []
        for chunk in texts.to_pylist():
            at = scan(chunk)
            heads.append([p for p in at if p <= overlap])
            tails.append([p - stride for p in at if p >= stride])
        kind = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array(heads, kind), pa.array(tails, kind)], ["head", "tail"])

    return find(text)


def encode(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", name: str = "ids",
    stride: int = 32768, overlap: int = 512,
) -> DataFrame:
    """Add the ids of each whole text: each match of ``pattern`` is merged by ``ranks`` on its own.

    Texts over ``stride`` characters are cut into chunks that overlap, and the
    chunks pre-tokenised in parallel. A scan from a wrong place soon falls in
    step with the true one: where a beginning in the overlap is common to the
    chunk before and the chunk itself, the text is cut for good. Chunks without
    a common beginning stay one piece. The pieces are encoded and their ids put
    together in order.

    A NULL or empty text gives an empty list, equal rows give equal rows, and
    an empty table an empty one. ``ranks`` is a path that every worker can read.
    """
    others = [F.col(f"`{c}`") for c in docs.columns]

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        words = rank_words(ranks, pattern)
        return lists([words.ids(t) if t else b"" for t in texts.to_pylist()])

    rows = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= stride).select("row", ids_of("text").alias("ids"))

    long = rows.filter(F.length("text") > stride).withColumn("doc", F.monotonically_increasing_id())
    last = F.floor((F.length("text") - 1) / F.lit(stride)).cast("int")
    long = long.select("doc", "row", "text", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    chunks = long.select(
        "doc", "k", F.when(F.col("k") == 0, F.col("row")).alias("row"),
        F.substring("text", F.col("k") * stride + 1, F.lit(stride + overlap)).alias("chunk"))
    # spread the chunks of one document before the heavy scan
    chunks = chunks.repartition(F.col("doc"), F.col("k")).withColumn(
        "begins", _overlap_begins(F.col("chunk"), stride, overlap, pattern))
    in_order = "partition by doc order by k"
    met = chunks.withColumn("cut", F.expr(
        f"case when k = 0 then 0 else array_min(array_intersect(begins.head, lag(begins.tail) over ({in_order}))) end"))
    met = met.withColumn("next", F.expr(f"lead(cut) over ({in_order})")).withColumn(
        "piece", F.expr(f"count(cut) over ({in_order})")).withColumn(
        "final", F.expr(f"lead(k) over ({in_order}) is null"))
    start = F.coalesce("cut", F.lit(0))
    end = F.when(F.col("final"), F.length("chunk")).otherwise(F.lit(stride) + F.coalesce("next", F.lit(0)))
    parts = met.select("doc", "piece", "k", "row", F.substring("chunk", start + 1, end - start).alias("part"))
    pieces = parts.groupBy("doc", "piece").agg(
        F.any_value("row", True).alias("row"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x["part"]), "")
        .alias("text"))
    pieces = pieces.select("doc", "piece", "row", ids_of("text").alias("ids"))
    whole = pieces.groupBy("doc").agg(
        F.any_value("row", True).alias("row"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias("ids"))
    both = short.unionByName(whole.select("row", "ids"))
    return both.select("row.*", F.col("ids").alias(name))


def decode(ids: Column | str, ranks: str) -> Column:
    """The bytes that ids stand for, put end to end; NULL stays NULL."""

    @F.arrow_udf("binary")
    def bytes_of(lists_: pa.Array) -> pa.Array:
        table = np.array(token_bytes(ranks), dtype=object)
        offsets = np.asarray(lists_.offsets)
        values = np.asarray(lists_.values)
        out = []
        for valid, a, b in zip(lists_.is_valid().to_pylist(), offsets[:-1], offsets[1:], strict=True):
            out.append(b"".join(table[values[a:b]]) if valid else None)
        return pa.array(out, pa.binary())

    return bytes_of(F.col(ids) if isinstance(ids, str) else ids)


# Fixed value: how byte-level tokenizer files cut a text when they give no pattern of their own.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from U+0100 on."""
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or (b >= 0xA1 and b != 0xAD)]
    others = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(others)}


def _ranks_of(spec: dict) -> dict[bytes, int] | None:
    """The ids of a plain byte-level BPE file as ranks, if its merges stand in the order of the ids they make."""
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
    extras = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or spec["normalizer"] or any(model.get(e) for e in extras):
        return None
    made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    vocabulary, letters = model["vocab"], byte_letters()
    if any(vocabulary.get(t) != len(letters) + k for k, t in enumerate(made)):
        return None
    apart = {t["content"] for t in spec["added_tokens"]}
    words = {t: i for t, i in vocabulary.items() if t not in apart}
    if len(words) != len(letters) + len(made) or not all(set(t) <= letters.keys() for t in words):
        return None
    return {bytes(letters[c] for c in t): i for t, i in words.items()}


def file_ids(path: str) -> Callable[[str | None], bytes]:
    """Packed ids of a whole text by a byte-level tokenizer file.

    Where the file's merges are nothing but ranks, the text goes through the rank
    encoder, which gives the same ids in a quarter of the time; a text with one of
    the file's special strings, and any other file, through the tokenizer itself.
    """
    found = worker_cache("file_ids")
    if path not in found:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        ranks = _ranks_of(json.loads(made.to_str()))
        bpe = ranks and tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        special = tuple(t.content for t in made.get_added_tokens_decoder().values())
        found[path] = made, bpe, special
    made, bpe, special = found[path]

    def ids(text: str | None) -> bytes:
        if not text:
            return b""
        if bpe is None or any(s in text for s in special):
            return array("i", made.encode(text, add_special_tokens=False).ids).tobytes()
        return array("i", bpe.encode_ordinary(text)).tobytes()

    return ids


def batches(frame: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows, fewer at a time."""
    for batch in frame:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
