"""Pruned neighbour search within a chunk: right answers, and few whole distances."""

import numpy as np
import pytest

from rillstone.operators.neighbors import _distances, closest_pruned, principal_axes


def plain(a, b, k):
    apart = _distances(a, b)
    return [(i, j, apart[i, j]) for i in range(len(a)) for j in sorted(range(len(b)), key=lambda j: (apart[i, j], j))[:k]]


def decaying(seed, n, dims=64, turn=True):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)) * 0.8 ** np.arange(dims)
    return v @ np.linalg.qr(np.random.default_rng(1).normal(size=(dims, dims)))[0] if turn else v


@pytest.mark.parametrize("k", [1, 7, 39])
@pytest.mark.parametrize("kind", ["decaying", "even", "ties", "constant", "few"])
def test_closest(kind, k):
    rng = np.random.default_rng(2)
    a, b = {
        "decaying": (decaying(3, 40), decaying(4, 600)), "even": (rng.normal(size=(30, 64)), rng.normal(size=(500, 64))),
        "ties": (rng.integers(0, 2, (25, 5)).astype(float), rng.integers(0, 2, (300, 5)).astype(float)),
        "constant": (np.ones((4, 3)), np.ones((50, 3))), "few": (decaying(3, 20), decaying(4, 3)),
    }[kind]
    rows, cols, apart, _ = closest_pruned(a, b, k, principal_axes(b))
    assert list(zip(rows.tolist(), cols.tolist(), apart.tolist(), strict=True)) == plain(a, b, k)


def test_most_rows_are_dismissed_early():
    a, b = decaying(5, 200), decaying(6, 4000)
    *_, full = closest_pruned(a, b, 10, principal_axes(b[:500]))
    assert full < 0.05 * len(a) * len(b)
    # along other axes than the principal ones the leading coordinates tell less
    *_, blind = closest_pruned(a, b, 10, np.eye(64))
    assert blind > 2 * full


def test_even_vectors_are_not_measured_pair_by_pair(monkeypatch):
    """Where leading axes tell little, a product leaves little more than the k closest to plain differences and sorting."""
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(300, 64)), rng.normal(size=(8000, 64))
    left, sort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: left.append(len(keys[0])) or sort(keys))
    rows, cols, apart, _ = closest_pruned(a, b, 15, principal_axes(b))
    assert sum(left) < 2 * 15 * len(a)
    assert list(zip(rows.tolist(), cols.tolist(), apart.tolist(), strict=True)) == plain(a, b, 15)


def test_values_far_from_zero():
    a, b = decaying(7, 30) + 1e6, decaying(8, 400) + 1e6
    rows, cols, apart, _ = closest_pruned(a, b, 5, principal_axes(b))
    assert list(zip(rows.tolist(), cols.tolist(), apart.tolist(), strict=True)) == plain(a, b, 5)
