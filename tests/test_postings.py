"""Terms by part and bucket against plain Python."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillstone.operators import postings as po
from rillstone.operators import termindex as ti

TEXTS = ["Red fox runs", "red red fox", None, "", "!!", "fox den fox den", "Über straße fox über straße", "blue hen", "red hen runs far",
         "a_word_of_more_than_eight_letters fox", "a_word_of_more_than_eight_lettern fox", "a_word_of_more_than_eight_letters hen"]


def terms(text):
    words = re.findall(r"[^\W]['\w]*\w|'['\w]*\w", (text or "").lower())
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


@pytest.mark.parametrize("parts, words", [(1, True), (5, True), (5, False)])
def test_found_terms_are_those_of_a_join(spark, parts, words):
    # keys repeat and may be NULL; texts repeat
    rows = [(None if i == 3 else i % 7, t) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "id int, text string").repartition(parts)
    held = ti.text_postings(docs, "text", "id") if words else ti.postings(docs, ti.text_terms("text"), "id")
    assert po.row_count(held) == len(rows)
    index = ti.term_index(docs, ti.text_terms("text"), 0.6, 4, held=held)
    counts = Counter(t for _, text in rows for t in terms(text))
    want = sorted((t for t, n in counts.items() if 4 <= n <= 0.6 * len(rows)), key=lambda t: t.encode())
    assert [(r["term"], r["code"], r["docs"]) for r in index.orderBy("code").collect()] == [(t, i, counts[t]) for i, t in enumerate(want)]
    got = ti.coded(docs, ti.text_terms("text"), index, "id", "docs", held=held)
    assert got.columns == ["id", "code", "docs"]
    code = {t: i for i, t in enumerate(want)}
    expected = Counter((key, code[t], counts[t]) for key, text in rows for t in terms(text) if t in code)
    assert Counter(map(tuple, got.collect())) == expected


def test_doubles_and_terms_unknown_to_the_rows(spark):
    docs = spark.createDataFrame([("a", "red fox"), ("b", None), ("c", "hen fox")], "id string, text string")
    weights = spark.createDataFrame([("fox", 0.5), ("hen fox", -2.0), ("nowhere", 9.0)], "term string, weight double")
    got = po.look_up(ti.postings(docs, ti.text_terms("text"), "id"), weights, "id", "weight").collect()
    assert sorted(map(tuple, got)) == [("a", 0.5), ("c", -2.0), ("c", 0.5)]
    assert po.look_up(ti.postings(docs, ti.text_terms("text"), "id"), weights.filter("term = 'nowhere'"), "id", "weight").count() == 0


def test_a_bucket_depends_on_the_term_alone():
    words = ["", "a", "seven77", "eight888", "nine99999", "ü" * 20, "x" * 100]
    alone = [po._bucket(pa.array([w]))[0] for w in words]
    assert po._bucket(pa.array(words)).tolist() == alone and po._bucket(pa.array(["zz", *words]).slice(1)).tolist() == alone
    assert len(set(po._bucket(pa.array([f"word{i} word{i * 7}" for i in range(100_000)])))) == po.BUCKETS


def test_a_large_partition_makes_several_parts(spark):
    rows = po.PART_ROWS + 10
    docs = spark.range(rows, numPartitions=1).select("id", F.array(F.col("id").cast("string"), F.lit("all")).alias("t"))
    held = ti.postings(docs, F.col("t"), "id")
    assert held.filter("bucket = -1").count() == 2 and po.row_count(held) == rows
    table = spark.createDataFrame([("all", 1), (str(rows - 1), 2)], "term string, code long")
    got = po.look_up(held, table, "id", "code")
    assert got.filter("code = 1").distinct().count() == rows and [r["id"] for r in got.filter("code = 2").collect()] == [rows - 1]


def test_counts_of_all_terms(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string").repartition(3)
    want = defaultdict(int)
    for text in TEXTS:
        for t in terms(text):
            want[t] += 1
    got = po.count_terms(ti.postings(docs, ti.text_terms("text"), "id"), 1, len(TEXTS))
    assert {r["term"]: r["docs"] for r in got.collect()} == dict(want)
