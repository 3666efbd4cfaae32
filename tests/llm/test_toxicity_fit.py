"""The fit on the driver: what it takes in memory, and very long words."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from tillstar.llm import toxicity

pytest.importorskip("public_tokenizers")


def test_a_fit_of_many_words_takes_little_memory():
    letters = np.random.default_rng(1).integers(97, 123, (12_000, 9), np.uint8)
    words = [row.tobytes().decode() for row in letters]
    tracemalloc.start()
    try:
        toxicity.fit_words(["0" + w for w in words[:4000]], words[4000:])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200e6


def test_a_word_longer_than_a_stretch_has_the_same_subsequences(monkeypatch):
    word = "".join(chr(c) for c in np.random.default_rng(2).integers(97, 123, 700))
    size = toxicity.SYMBOLS**3
    _, code, weight = toxicity.subsequences([word])
    whole = np.bincount(code, weight, size)
    monkeypatch.setattr(toxicity, "STRETCH", 100)
    parts = list(toxicity._few_at_once(["ab", word, "cd"]))
    assert [(at, n) for at, n, _ in parts] == [(0, 1), (1, 1), (2, 1)]
    _, code, weight = parts[1][2]
    assert len(np.unique(code)) == len(code)
    np.testing.assert_allclose(np.bincount(code, weight, size), whole, atol=1e-12)
