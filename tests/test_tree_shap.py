"""Attributions of deep trees against the sum over all sets of known features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest

from sparkrisk.operators import explain
from sparkrisk.operators.explain import _attributions, _leaf_games


def deep_leaves(features, depth, n, seed):
    """Paths that may test a feature more than once."""
    rng = np.random.RandomState(seed)
    return [{"value": float(rng.normal()), "path": [
        (int(rng.randint(features)), float(rng.normal()), bool(rng.randint(2)), float(rng.uniform(0.05, 0.95))) for _ in range(depth)]} for _ in range(n)]


def reach(leaf, row, known):
    """The leaf's value if only some features are known."""
    out = leaf["value"]
    for f, threshold, left, share in leaf["path"]:
        out *= float((row[f] <= threshold) == left) if f in known else share
    return out


def plain(leaves, row, features):
    phi = np.zeros(features)
    for f in range(features):
        rest = [p for p in range(features) if p != f]
        for size in range(features):
            weight = factorial(size) * factorial(features - size - 1) / factorial(features)
            for known in combinations(rest, size):
                phi[f] += weight * sum(reach(x, row, {*known, f}) - reach(x, row, known) for x in leaves)
    return phi


@pytest.mark.parametrize("depth", [1, 2, 3, 10])
def test_values_equal_the_sum_over_sets(depth):
    leaves = deep_leaves(8, depth, 6, depth)
    rows = np.random.RandomState(1).normal(size=(5, 8))
    got = _attributions(rows, _leaf_games(leaves)[0])
    for row, phi in zip(rows, got):
        assert phi == pytest.approx(plain(leaves, row, 8), abs=1e-12)


def test_thirty_features_on_a_path_add_up():
    """Two to the thirtieth sets; the values and the base make the margin."""
    leaves = deep_leaves(60, 30, 40, 7)
    rows = np.random.RandomState(2).normal(size=(50, 60))
    games, base = _leaf_games(leaves)
    margins = [sum(reach(x, row, range(60)) for x in leaves) for row in rows]
    assert _attributions(rows, games).sum(axis=1) + base == pytest.approx(margins, abs=1e-12)


def test_outcomes_of_short_paths_are_tabled():
    """Values are looked up by the outcomes of a leaf's tests, and are those of the sum that long paths take."""
    short, long = (_leaf_games(deep_leaves(12, depth, 5, depth))[0] for depth in (3, 30))
    assert all(table is not None for *_, table in explain._tabled(short))
    assert all((table is None) == (len(players) > explain._TABLED) for players, *_, table in explain._tabled(long))
    rows = np.random.RandomState(3).normal(size=(40, 12))
    got = _attributions(rows, short)
    explain._TABLED, kept = 0, explain._TABLED
    try:
        assert (got == _attributions(rows, short)).all()
    finally:
        explain._TABLED = kept
