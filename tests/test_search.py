"""Guided search against random search, and attributions against all subsets of features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest

from riskflow.models.attribution import Node, attribute, leaves_of
from riskflow.models.parzen import Parzen, ParzenSearch, Range

SPACE = [Range("a", 0.01, 0.3, log=True), Range("b", 2, 6, whole=True), Range("c", 0, 1), Range("d", 0, 1), Range("e", 0, 1)]


def peak(p):
    return -((p[0] - 0.7) ** 2 + (p[1] - 0.2) ** 2 + (p[2] - 0.55) ** 2 + (p[3] - 0.9) ** 2 + (p[4] - 0.35) ** 2)


def test_guided_search_beats_random_search():
    guided, plain = [], []
    for seed in range(12):
        s = ParzenSearch(SPACE, seed)
        for _ in range(8):
            places = s.propose(5)
            s.tell(places, [peak(p) for p in places])
        guided.append(max(s.scores))
        plain.append(max(peak(p) for p in np.random.default_rng(seed).random((40, 5))))
    assert np.mean(guided) > np.mean(plain) and np.median(guided) > 0.7 * np.median(plain)


def test_values_stay_in_their_ranges():
    for u in np.linspace(0, 1, 101):
        for r in SPACE:
            v = r.value(u)
            assert r.low <= v <= r.high and (v == int(v) or not r.whole)
    assert {Range("b", 2, 6, whole=True).value(u) for u in np.linspace(0, 1, 101)} == {2, 3, 4, 5, 6}


def test_density_is_one_over_the_range():
    x = np.linspace(0, 1, 20_001)
    assert np.trapezoid(np.exp(Parzen(np.array([0.1, 0.15, 0.8])).log_density(x)), x) == pytest.approx(1, abs=1e-3)


def grown(rng, depth, features):
    if depth == 0 or rng.random() < 0.15:
        return Node(float(rng.integers(1, 20)), float(rng.normal()))
    left, right = grown(rng, depth - 1, features), grown(rng, depth - 1, features)
    return Node(left.count + right.count, 0.0, int(rng.integers(features)), float(rng.normal()), left, right)


def expected(node, x, known):
    if node.left is None:
        return node.value
    if node.feature in known:
        return expected(node.left if x[node.feature] <= node.threshold else node.right, x, known)
    return (node.left.count * expected(node.left, x, known) + node.right.count * expected(node.right, x, known)) / node.count


def test_attributions_equal_all_subsets():
    rng, n = np.random.default_rng(2), 5
    for _ in range(20):
        tree = grown(rng, 4, n)
        x = rng.normal(size=(6, n))
        leaves, base = leaves_of(tree, 0.5)
        got = attribute(leaves, x)
        assert base == pytest.approx(0.5 * expected(tree, x[0], set()))
        for row, found in zip(x, got, strict=True):
            for i in range(n):
                others = [j for j in range(n) if j != i]
                want = sum(factorial(k) * factorial(n - k - 1) / factorial(n) * (expected(tree, row, {*s, i}) - expected(tree, row, set(s)))
                           for k in range(n) for s in combinations(others, k))
                assert found[i] == pytest.approx(0.5 * want, abs=1e-9)
            assert base + found.sum() == pytest.approx(0.5 * expected(tree, row, set(range(n))))
