"""Planted pairs close to the threshold, over many shards."""

import numpy as np
import pytest

from rillstone.llm import neargraph

SCHEMA = "vec_id long, embedding array<double>, label string, node long, cells string, visits int"


def planted(spark, n, seed=3, dims=64):
    """``n`` random directions, and for every tenth a partner at a cosine of 0.931 to 0.95."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    some = base[::10]
    off = rng.normal(size=some.shape)
    off -= (off * some).sum(1, keepdims=True) * some
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    alike = rng.uniform(0.931, 0.95, (len(some), 1))
    rows = np.vstack([base, alike * some + np.sqrt(1 - alike**2) * off])
    columns = [(i, v.tolist(), "one", 0, "x", 1) for i, v in enumerate(rows)]
    return spark.createDataFrame(columns, SCHEMA).repartition(8), {n + k: 10 * k for k in range(len(some))}


@pytest.mark.parametrize("shards", [4, 120])
def test_planted_pairs_are_joined(spark, shards):
    df, pairs = planted(spark, 6000)
    got = {r["vec_id"]: r for r in neargraph.near_duplicates(
        df, settings=neargraph.Settings(per_centre=6600 // shards)).collect()}
    joined = sum(got[a]["component_id"] == b and got[b]["component_id"] == b for a, b in pairs.items())
    assert joined >= 0.98 * len(pairs)
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * 2 * len(pairs)
    assert all(r["n_links"] <= 1 for r in got.values()) and got[1]["recall"] >= 0.95


def test_a_poor_search_is_repeated_wider(spark, monkeypatch):
    df, pairs = planted(spark, 3000)
    poor = neargraph.Settings(per_centre=30, overlap=1, reach=0.0, beam=2)
    monkeypatch.setattr(neargraph, "ATTEMPTS", 1)
    once = neargraph.near_duplicates(df, settings=poor).filter("n_links > 0").count()
    monkeypatch.setattr(neargraph, "ATTEMPTS", 3)
    again = neargraph.near_duplicates(df, settings=poor)
    assert again.filter("n_links > 0").count() > once and again.first()["recall"] > 0.9


def test_nothing_to_audit(spark):
    df, _ = planted(spark, 50)
    rows = neargraph.near_duplicates(df.filter("vec_id < 50")).collect()
    assert {r["recall"] for r in rows} == {None} and {r["n_links"] for r in rows} == {0}
