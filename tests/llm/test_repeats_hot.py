"""Repeats where many rows share an id or have none; language samples of such rows."""

import pytest
from pyspark.sql import functions as F

from rillstone.llm import language, repeats
from tests.llm.test_operators import PASSAGE

WORDS = [f"w{i * i % 997:03d}" for i in range(997)]


def text(seed, n=60):
    return " ".join(WORDS[(seed * 31 + k * 7) % 997] for k in range(n))


@pytest.mark.parametrize("hot", [None, 7], ids=["no id", "one id"])
def test_rows_of_one_id_lie_in_several_blocks(spark, hot):
    own = lambda i: " ".join(f"{i}x{k}y{i * k}" for k in range(40))
    rows = [(hot, f"{own(i)} {PASSAGE * 2} {own(i + 500)}") for i in range(40)] + [(i + 100, own(1000 + i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, body string").repartition(4)
    dealt, _ = repeats.in_blocks(docs, "id", "body", 2000)
    assert dealt.filter(F.col("id").eqNullSafe(F.lit(hot))).select("block").distinct().count() > 2
    got = [r for r in repeats.without_repeats(docs, "id", "body", block_bytes=2000).collect() if r["id"] == hot]
    assert len(got) == 40
    removed = sorted(r["n_removed"] for r in got)
    # the passage stands twice in a row in each: the second goes everywhere, the first in all rows but one
    n = len(PASSAGE)
    assert n - 100 <= removed[0] <= n + 20 and all(2 * n - 4 <= r <= 2 * n + 20 for r in removed[1:])


@pytest.mark.parametrize("hot", [None, 7], ids=["no id", "one id"])
def test_of_copies_that_share_an_id_one_stays(spark, hot):
    rows = [(hot, text(1))] * 50 + [(1, text(2)), (2000, text(2) + " and more")]
    got = repeats.without_repeats(spark.createDataFrame(rows, "id long, body string"), "id", "body", block_bytes=1000).collect()
    whole = [r for r in got if r["id"] == hot and r["n_removed"] == 0]
    assert len(whole) == 1 and all(r["n_removed"] == r["n_bytes"] for r in got if r["id"] == hot and r is not whole[0])
    assert {r["id"]: r["n_removed"] > 0 for r in got if r["id"] in (1, 2000)} == {1: False, 2000: True}


def test_languages_are_learned_from_rows_that_share_an_id(spark):
    lines = {"en": "the quick brown fox jumps over the lazy dog again", "de": "der schnelle braune Fuchs springt über den faulen Hund"}
    rows = [(5, f"{lines[x]} {i % 90}", x) for i in range(3000) for x in lines] + [(5, lines["en"], "en")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, sample=50)
    asked = spark.createDataFrame([(1, lines["de"]), (2, lines["en"]), (3, "12 34"), (4, None), (5, "Reouti anatha. 19.37")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(asked, model).collect()}
    assert got[1]["lang_pred"] == "de" and got[2]["lang_pred"] == "en"
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and not got[3]["known"]
    assert got[5]["lang_pred"] in ("de", "en") and got[5]["score"] > 0


def test_one_row_repeated_is_a_language_of_its_own(spark):
    rows = [(1, "una sola frase que se repite", "es")] * 2000 + [(i, f"some english words {i}", "en") for i in range(300)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=20)
    assert sorted(model.languages) == ["en", "es"]
