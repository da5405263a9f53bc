"""The conversation trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rillstone.llm import queries, turntrie

SCHEMA = "conv_id long, turn long, role string, text string, words string, key string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)} {role}{text}".encode()).digest()[:16]


def sequences(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""),
                                            len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, seq in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + seq[h:]
    return out


def expected(convs):
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved, rows = {}, {}, []
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids.get(path, [])) or 1
        saved[path] = sum(saved[k] for k in kids.get(path, [])) + (
            (len(nodes[path]) - 1) * path[-1][1] if path else 0)
        ends = sorted(c for c in nodes[path] if len(convs[c]) == len(path))
        rows.append((min(nodes[path]), len(path), min(nodes[path[:-1]]) if path else None, len(nodes[path]),
                     len(kids.get(path, [])), leaves[path], saved[path],
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def found(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def chatter(seed, convs, turns, words):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), " ".join(rng.choices(words, k=rng.randint(0, 2))))
            for c in range(convs) for t in range(rng.randint(1, turns))]


CASES = {
    "few words": chatter(1, 300, 5, ["a", "b"]),
    "many words": chatter(2, 200, 9, [f"w{i}" for i in range(50)]),
    "one copied a thousand times": [(c, t, "user", f"turn {t}") for c in range(1100) for t in range(3)] + chatter(3, 60, 4, ["a"]),
    "nulls": [(1, None, None, None), (1, 1, "user", None), (1, None, "user", ""), (None, 1, "user", "x"), (2, 1, None, ""),
              (2, 0, "", None), (-7, 1, "user", "x y"), (-7, 1, "user", "x y"), (0, 3, "a", "b"), (40, 1, "a", None)],
    "long": [(5, t, "user", f"t{t % 7}") for t in range(6000)] + [(6, t, "user", f"t{t % 7}") for t in range(5990)],
    "role and text run together": [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc")],
    "very long text": [(1, 0, "u", "w " * 300_000), (2, 0, "u", "w " * 300_000), (3, 0, "u", "w " * 299_999)],
}


@pytest.mark.parametrize("name", CASES)
def test_nodes(spark, name):
    convs = sequences(CASES[name])
    assert found(turntrie.trie(turntrie.sequences(table(spark, CASES[name])))) == expected(convs)


@pytest.mark.parametrize("name", ["few words", "nulls", "one copied a thousand times"])
def test_rebuilt(spark, name):
    got = turntrie.trie(queries.rebuilt(turntrie.sequences(table(spark, CASES[name]))))
    assert found(got) == expected(rebuilt(sequences(CASES[name])))


@pytest.mark.parametrize("name", ["few words", "many words", "one copied a thousand times"])
def test_many_ranges_joined_in_several_steps(spark, name, monkeypatch):
    monkeypatch.setattr(turntrie, "FAN", 3)
    got = turntrie.trie(turntrie.sequences(table(spark, CASES[name])), each=64)
    assert found(got) == expected(sequences(CASES[name]))


def test_empty(spark):
    assert found(turntrie.trie(turntrie.sequences(table(spark, [])))) == []
    assert found(turntrie.trie(turntrie.sequences(table(spark, [(None, 1, "user", "x")])))) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    none = F.array().cast("array<binary>")
    seqs = spark.createDataFrame([(3,), (1,)], "conv_id long").select(
        "conv_id", none.alias("digests"), F.array().cast("array<long>").alias("words"))
    ids = hashlib.sha256(b"1,3").hexdigest()
    assert found(turntrie.trie(seqs)) == [(1, 0, None, 2, 0, 1, 0, ids)]


def test_median_insertion_balances():
    tree = turntrie.TernaryTree()
    for k in turntrie.median_first(1023):
        tree.insert([k], [1])
    depth, stack = 0, [(tree.eq[0], 1)]
    while stack:
        k, d = stack.pop()
        if k >= 0:
            depth = max(depth, d)
            stack += [(tree.lo[k], d + 1), (tree.hi[k], d + 1)]
    assert depth == 10
