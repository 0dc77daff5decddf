"""Elias-Fano look-ups against plain search, and what a look-up costs."""

from __future__ import annotations

import numpy as np
import pytest

from marketlens.llm.elias_fano import EliasFano, Shards, select1


def numbers(rng: np.random.Generator, kind: str) -> np.ndarray:
    if kind == "runs":  # many numbers share a higher part, among wide gaps
        parts = [b + np.arange(rng.integers(1, 400)) for b in rng.integers(0, 1 << 40, 60)]
        return np.unique(np.concatenate(parts))
    return np.unique(rng.integers(0, {"dense": 6000, "wide": 1 << 60, "one": 1 << 30}[kind], 1 if kind == "one" else 5000))


def test_select1_finds_every_one():
    rng = np.random.default_rng(3)
    words = np.concatenate([rng.integers(0, 1 << 63, 200, dtype=np.uint64), np.array([1, 1 << 63, 2 ** 64 - 1], dtype=np.uint64)])
    for x in words:
        places = [i for i in range(64) if int(x) >> i & 1]
        assert select1(np.full(len(places), x), np.arange(len(places))).tolist() == places


@pytest.mark.parametrize("kind", ["dense", "wide", "runs", "one"])
@pytest.mark.parametrize("ordered", [True, False])
def test_search_equals_plain_search(kind, ordered):
    rng = np.random.default_rng(8)
    values = numbers(rng, kind)
    asked = np.concatenate([values, values - 1, values + 1, rng.integers(0, values[-1] + 10, 3000), [0, values[-1] + 10 ** 6]])
    asked = np.sort(asked) if ordered else rng.permutation(asked)
    for cuts in ([], [len(values) // 3, len(values) // 2]):
        shards = Shards([EliasFano.build(x) for x in np.split(values, cuts)])
        at, there = shards.lower_bound(asked)
        assert (at == np.searchsorted(values, asked)).all() and (there == np.isin(asked, values)).all()
        assert (shards.find(asked) == np.where(there, at, -1)).all()


def test_one_select_a_search(monkeypatch):
    rng = np.random.default_rng(4)
    values = numbers(rng, "wide")
    shards = Shards([EliasFano.build(x) for x in np.split(values, [1000, 2500])])
    selected, plain = [], EliasFano.select0
    monkeypatch.setattr(EliasFano, "select0", lambda self, k: selected.append(len(k)) or plain(self, k))
    asked = rng.permutation(np.concatenate([values, values + 1]))
    shards.lower_bound(asked)
    assert sum(selected) < 1.2 * len(asked)
