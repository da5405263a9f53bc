"""Mixing against a plain greedy walk through the documents in hash order."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rillstone.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, taken string, high string"


def hashed(row):
    return hashlib.md5(f"{'' if row[0] is None else row[0]} {row[1] or ''}".encode()).hexdigest()[:15]


def expected(rows):
    """Targets by repeated rounds, then documents in the order of their hash."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    own = {s: sum(n for r, n in zip(rows, sizes, strict=True) if r[2] == s) for s in names}
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(own.values())
    while free:
        rate = rest / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * rate > 3 * own[s]}
        if not above:
            target |= {s: weight[s] * rate for s in free}
            break
        target |= {s: 3 * own[s] for s in above}
        rest -= sum(3 * own[s] for s in above)
        free -= above
    got = []
    for s in names:
        mine = sorted((hashed(r), n, i) for i, (r, n) in enumerate(zip(rows, sizes, strict=True)) if r[2] == s)
        copies = int(target[s] // own[s]) if own[s] else 0
        budget, upto = target[s] - copies * own[s], 0
        for _, n, i in mine:
            more = upto < budget and upto + n - budget < budget - upto
            upto += n
            got.append((rows[i][0], n, own[s], pytest.approx(target[s]), n * (copies + more)))
    return sorted(got, key=lambda r: (r[0] is None, r[0], r[1], r[4]))


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = mixing.mix(docs).select("id", "size", "source_size", "target", "taken").collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0], r[1], r[4]))


CASES = {
    "sources": [(i, "w " * (i * 7 % 23), f"s{i % 5}") for i in range(400)],
    "hot source": [(i, "w " * (1 + i % 9), "big" if i % 3 else f"s{i % 40}") for i in range(600)],
    "nulls and blanks": [(1, None, "a"), (None, "one two", None), (2, "", "b"), (3, " \t\n", None), (4, "x", ""),
                         (None, "one two", None), (None, None, None), (5, "a b c", "b")],
    "alike": [(7, "three words here", "a")] * 90 + [(8, "b", "b")] * 30 + [(None, "c c", None)] * 50,
    "very long": [(1, "w " * 200_000, "a"), *[(i, "w w w", "b") for i in range(2, 300)], (900, "w " * 999, "é")],
    "no word at all": [(1, None, "a"), (2, "", "b")],
    "one": [(1, "a b c", "only")],
}


@pytest.mark.parametrize("name", CASES)
def test_mix(spark, name):
    assert found(spark, CASES[name]) == expected(CASES[name])


def test_empty(spark):
    assert found(spark, []) == []


def test_words_come_near_their_targets_and_repeat(spark):
    rows = CASES["hot source"]
    got = found(spark, rows)
    assert got == found(spark, rows[::-1])
    by_size = {}
    for _, size, source_size, target, taken in got:
        assert taken <= 3 * size
        aim = by_size.setdefault((source_size, target), [0, 0])
        aim[0] += taken
        aim[1] = max(aim[1], size)
    same = spark.createDataFrame(rows, "doc_id long, text string, source string").groupBy("source").agg(
        F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).groupBy("n").count().collect()
    several = {r["n"]: r["count"] for r in same}  # sources of one size and target are summed together above
    for (source_size, target), (taken, longest) in by_size.items():
        n = several[source_size]
        assert min(abs(taken - k * target) for k in range(1, n + 1)) <= n * longest


def test_one_hash_bucket_is_refined(spark):
    """Documents of one text and id differ in their row's number only: the search reads on to that."""
    got = found(spark, CASES["alike"])
    of_a = [r for r in got if r[0] == 7]
    assert {r[4] for r in of_a} <= {0, 3, 6, 9} and len({r[4] for r in of_a}) == 2
    assert abs(sum(r[4] for r in of_a) - of_a[0][3]) <= 3
