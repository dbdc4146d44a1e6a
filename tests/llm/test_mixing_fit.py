"""The knapsack against all subset sums."""

import numpy as np
import pytest

from orefold.llm import mixing


def best(lengths, counts, budget):
    sums = {0}
    for x, n in zip(lengths.tolist(), counts.tolist(), strict=True):
        sums = {s + x * i for s in sums for i in range(n + 1)}
    return min(abs(s - budget) for s in sums)


@pytest.mark.parametrize("window", [1, 50, 1 << 13])
def test_no_choice_is_nearer(monkeypatch, window):
    monkeypatch.setattr(mixing, "KNAPSACK", window)
    rng = np.random.default_rng(window)
    for _ in range(300):
        lengths = np.unique(rng.integers(0, rng.choice([12, 100, 1000]), rng.integers(1, 9)) * rng.choice([1, 1, 7]))
        counts = rng.integers(0, 6, len(lengths))
        total = int((lengths * counts).sum())
        budget = int(rng.integers(0, total + 20))
        taken = mixing.fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        assert abs(int((lengths * taken).sum()) - budget) == best(lengths, counts, budget)


def test_many_lengths_and_documents():
    rng = np.random.default_rng(2)
    lengths = np.unique(rng.integers(20, 20_000, 6_000))
    counts = rng.integers(1, 1_000_000, len(lengths))
    total = int((lengths * counts).sum())
    for budget in (1, 777, total // 3, total - 5_001):
        taken = mixing.fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        off = abs(int((lengths * taken).sum()) - budget)
        assert off == 0 or budget < 20_000
