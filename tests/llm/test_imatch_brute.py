"""I-Match fingerprints, edits and likenesses against plain Python."""

import hashlib
import math
import random
import struct

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from rillstone.llm import imatch

SCHEMA = "doc_id long, text string, block int, next string"


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def unsigned(h):
    return h & ((1 << 64) - 1)


def hash_text(t):
    return signed(xxhash.xxh64_intdigest(t.encode(), 42))


def hash_long(h, seed=42):
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", h), unsigned(seed)))


def terms(text):
    return list(dict.fromkeys(hash_text(w) for w in regex.findall(r"[\p{L}\p{N}]+", text.lower())))


def fingerprint(text, lexicon, wanted=24):
    kept = [t for t in terms(text) if t in lexicon]
    level = max(0, math.ceil(math.log2(max(len(kept), 1) / wanted)))
    out = []
    for step in range(imatch.LEVELS):
        thin = [h for h in kept if hash_long(h) % 2 ** (level + step) == 0]
        for part in range(imatch.PARTS):
            mine = sorted(h for h in thin if signed(
                xxhash.xxh64_intdigest(struct.pack("<i", part), unsigned(hash_long(h)))) % imatch.SPARSE == 0)
            if mine:
                whole = 42
                for h in mine:
                    whole = hash_long(h, whole)
                out.append(f"{level + step:x}.{part:x}.{unsigned(whole):016x}"[:-8])
    return out or ["text.." + hashlib.sha256(text.encode()).hexdigest()[:16]]


def likeness(a, b):
    label = lambda x: x.rsplit(".", 1)[0]
    return len(set(a) & set(b)) / len({label(x) for x in a} | {label(x) for x in b})


def expected(rows, low, high):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hash_text(r[1]), r[1]))
    df = {}
    for _, t in rows:
        for h in terms(t):
            df[h] = df.get(h, 0) + 1
    n = len(rows)
    lexicon = {h for h, c in df.items() if max(2.0, low * n) <= c <= max(2.0, high * n)}
    out = []
    for k, (i, t) in enumerate(rows):
        other = rows[(k + 1) % n][1]
        cut = len(t) // 3
        edit = t[:len(t) - cut] + other[:cut]
        a, b, c = (fingerprint(x, lexicon) for x in (t, edit, other))
        out.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), "-".join(a), "-".join(b),
                    pytest.approx(likeness(a, b)), pytest.approx(likeness(a, c))))
    return sorted(out, key=lambda r: (repr(r[0]), r[2:5]))


def chatter(seed, n, words, length):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{rng.randrange(words)}" for _ in range(rng.randint(0, length)))) for i in range(n)]


CASES = {
    "words": chatter(1, 120, 200, 150),
    "ids": [(i * i * 977 - 10**12, t) for i, t in chatter(2, 80, 60, 30)],
    "hot id": [(7 if i % 3 else i, t) for i, t in chatter(3, 200, 300, 40)],
    "no id": [(None if i % 3 else i, t) for i, t in chatter(4, 200, 300, 40)],
    "only without id": [(None, t) for _, t in chatter(5, 40, 90, 20)],
    "copies": [(3, "the same words again")] * 40 + [(2, "the other words")] * 2 + [(9, None), (None, ""), (8, "Éa b ü")],
    "long": [(1, " ".join(f"w{k % 400}" for k in range(30_000))), *[(i, " ".join(f"w{k}" for k in range(i, i + 300))) for i in range(2, 20)]],
    "one": [(5, "alone with itself and nobody else")],
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    docs = spark.createDataFrame([(*r, 1, "x") for r in CASES[name]], SCHEMA).repartition(3)
    got = imatch.compare(docs, low=0.01, high=0.4).collect()
    assert sorted(map(tuple, got), key=lambda r: (repr(r[0]), r[2:5])) == expected(CASES[name], 0.01, 0.4)


@pytest.mark.parametrize("name", ["words", "copies", "no id"])
def test_both_ways_of_lookup_agree(spark, name):
    docs = spark.createDataFrame([(*r, 1, "x") for r in CASES[name]], SCHEMA)
    rows = [sorted(map(tuple, imatch.compare(docs, low=0.01, high=0.4, inline=n).collect()), key=repr) for n in (0, 100_000)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("name", ["hot id", "no id", "ids", "copies", "one", "only without id"])
def test_small_blocks_keep_the_order(spark, name):
    docs = spark.createDataFrame([(*r, 1, "x") for r in CASES[name]], SCHEMA).repartition(3)
    rows = sorted(((i, t or "") for i, t in CASES[name]), key=lambda r: (r[0] is None, -(r[0] or 0), hash_text(r[1]), r[1]))
    want = sorted(((*r, rows[(k + 1) % len(rows)][1]) for k, r in enumerate(rows)), key=repr)
    got = imatch.with_next(docs, "doc_id", "text", each=100)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    if name in ("hot id", "no id"):
        hot = imatch.in_blocks(docs, "doc_id", "text", 100).filter(F.col("id").eqNullSafe(F.lit(7 if name == "hot id" else None)))
        assert hot.select("block").distinct().count() > 3
