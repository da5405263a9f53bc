"""Ranked search against scores computed document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rillstone.llm import treap

DOCS = "doc_id long, text string, item_id long, score string, terms string"
ITEMS = "item_id long, text string, rank string, doc_id string"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def expected(docs, items, k):
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, words = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    rows = []
    for item, text in sorted(set((i, t or "") for i, t in items), key=repr):
        scores = []
        for (doc, _), c in zip(docs, counts, strict=True):
            m = 10 + (90 * sum(c.values()) * n_docs) // max(words, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(scores)[:k], 1):
            rows.append((item, rank, None if missing else doc, -score))
    return sorted(rows, key=repr)


def found(spark, docs, items, **options):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in docs], DOCS).repartition(3)
    items = spark.createDataFrame([(*r, "x", "y") for r in items], ITEMS)
    return sorted((tuple(r) for r in treap.search(docs, items, **options).collect()), key=repr)


def chatter(seed, docs, words, length):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(names, weights, k=rng.randint(1, length)))) for i in range(docs)]


CASES = {
    "words": (chatter(1, 400, 300, 60), chatter(2, 30, 300, 20)),
    "ties": ([(i, "same words here" if i % 2 else f"same other {i}") for i in range(200)], [(1, "same words"), (2, "here"), (2, "same")]),
    "repeated rows": ([(7, "a b c")] * 30 + [(8, "a b")] * 3 + [(9, "zz")] * 40, [(1, "a"), (1, "a"), (1, "b a"), (None, "c")]),
    "nulls and blanks": ([(1, None), (2, ""), (None, "x y"), (None, "x"), (3, "X-Y, x!"), (4, "...")], [(1, "x"), (2, None), (3, ""), (4, "--")]),
    "letters": ([(1, "Été É é"), (2, "ÉTÉ"), (3, "naïve Ab9ab9 AB9"), (4, "日本 語")], [(1, "été"), (2, "ab9 AB9"), (3, "日本"), (4, "É")]),
    "very long": ([(1, "long " * 100_000 + "rare"), (2, "rare"), *[(i, f"w{i} long") for i in range(3, 90)]],
                  [(1, "rare long"), (2, " ".join(f"w{i}" for i in range(5000)))]),
    "one word everywhere": ([(i, "the " * (1 + i % 5) + f"w{i % 17}") for i in range(500)], [(1, "the"), (2, "the w3"), (3, "w3 w4")]),
}


@pytest.mark.parametrize("name", CASES)
def test_search(spark, name):
    docs, items = CASES[name]
    assert found(spark, docs, items) == expected(docs, items, 10)


@pytest.mark.parametrize("name", ["words", "ties", "repeated rows"])
def test_small_shards_and_blocks(spark, name):
    docs, items = CASES[name]
    assert found(spark, docs, items, each=300, block=3, k=4) == expected(docs, items, 4)


def test_empty(spark):
    docs, items = CASES["words"]
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_tree_keeps_every_cell_and_its_maximum():
    rng = np.random.default_rng(5)
    cells = np.unique(rng.integers(0, [3000, 500], (4000, 2)), axis=0)
    impact = rng.integers(1, 1_000_000, len(cells))
    tree = treap.Treap.unpacked(treap.Treap.of(cells[:, 0], cells[:, 1], impact).packed())
    points = tree.level == 0
    got = sorted(zip(tree.row[points].tolist(), tree.col[points].tolist(), tree.top[points].tolist(), strict=True))
    assert got == sorted(zip(*cells.T.tolist(), impact.tolist(), strict=True))
    assert len(tree.level) < 2 * len(cells)  # cells without branching are skipped
    for k in np.flatnonzero(~points):
        mine = (cells >> int(tree.level[k]) == [tree.row[k], tree.col[k]]).all(axis=1)
        assert tree.top[k] == impact[mine].max()
        if k > 40:
            break


def test_search_opens_few_cells():
    """A rare heavy term decides: ranges without it stay closed."""
    docs = 4096
    row = np.r_[np.zeros(docs, np.int64), np.full(10, 4095)]  # neighbouring rows would share their cells
    col = np.r_[np.arange(docs), np.arange(10) * 400]
    tree = treap.Treap.of(row, col, np.full(len(row), 1000))
    opened = []
    original = tree._opened
    tree._opened = lambda *a: (opened.append(len(a[0])), original(*a))[1]
    item, at, score = tree.best(np.zeros(2, np.int64), np.array([0, 4095]), np.array([1, 1000]), np.zeros(1, np.int64), 10)
    assert at.tolist() == (np.arange(10) * 400).tolist() and set(score.tolist()) == {1_001_000}
    assert sum(opened) < docs / 4
