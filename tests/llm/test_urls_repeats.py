"""Training on distinct URLs, whatever the rows repeat; columns of the same names as the results."""

import pytest

from rillstone.llm import urls
from rillstone.llm.queries import RULES


def pages(n=120):
    block = [f"http://example.com/en/a{i}?p={i}" for i in range(n)] + [f"https://x{i % 7}.net/es/{i}" for i in range(n)]
    allow = [f"http://shop{i % 9}.com/item/{i}" for i in range(n)]
    return block + allow + [f"http://other{i}.org/p/{i}" for i in range(20)] + [None, "", "no scheme", "http://" + "long/" * 20_000]


@pytest.fixture(scope="module")
def once(spark):
    return spark.createDataFrame([(i, u, "h", "p", "r", "v") for i, u in enumerate(pages())],
                                 "page_id int, url string, host string, path string, rule string, verdict string")


def test_a_repeated_url_counts_once(spark, once):
    hot = once.unionByName(once.filter("page_id = 3").crossJoin(spark.range(500)).drop("id"))
    models = [urls.fit(rows, RULES) for rows in (once, hot)]
    assert models[0].prior == models[1].prior
    for n in urls.Filter.SUFFIXES:
        a, b = (sorted(map(tuple, m.suffixes[n].collect()), key=repr) for m in models)
        assert a == b
    # with far fewer URLs sampled than there are, one that is repeated does not fill the sample
    assert urls.fit(hot, RULES, sample=40).model is not None


def test_answers_and_clashing_columns(once):
    got = urls.fit(once, RULES).judge(once)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict", "block_score"]
    rows = {r["page_id"]: r for r in got.collect()}
    assert len(rows) == len(pages())
    for k, url in enumerate(pages()):
        assert rows[k]["url"] == url
        if url and url.startswith("http://example.com/en/"):
            assert (rows[k]["rule"], rows[k]["verdict"]) == ("example.com/en/", "block")
        if not url or "://" not in url:
            assert rows[k]["host"] == rows[k]["path"] == "" and rows[k]["rule"] is None
    assert rows[len(pages()) - 1]["host"] == "long" and len(rows[len(pages()) - 1]["path"]) == 99_996
