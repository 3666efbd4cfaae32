"""Word values against the definition of the kernel machine; scoring of odd tables."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from tillstar.llm import toxicity

pytest.importorskip("public_tokenizers")


def brute_force(word: str, weights: np.ndarray) -> float:
    """Every three characters of the marked word within SPAN, weighted by the stretch they span."""
    table = toxicity._TABLE
    symbols = [toxicity._START, *(int(table[min(ord(c), 0xFFFF)]) for c in word), toxicity._END]
    value = norm = 0.0
    for at in itertools.combinations(range(len(symbols)), 3):
        a, b, c = (symbols[i] for i in at)
        stretch = at[2] - at[0] + 1
        if stretch <= toxicity.SPAN and a and b and c:
            size = toxicity.SYMBOLS
            value += weights[(a * size + b) * size + c] * toxicity.DECAY**stretch
            norm += toxicity.DECAY ** (2 * stretch)
    return value / math.sqrt(norm) if norm else 0.0


WORDS = ["idiot", "1d-i.o_t", "x", "", "-", "é", "straße", "aaaaaaaaaaaa", "a b"]


@pytest.mark.parametrize("stretch", [1 << 16, 5, 1])
def test_values_equal_brute_force(monkeypatch, stretch):
    monkeypatch.setattr(toxicity, "STRETCH", stretch)
    weights = np.random.default_rng(1).standard_normal(toxicity.SYMBOLS**3)
    got = toxicity.Model(weights, 0.25).values(WORDS)
    assert np.allclose(got - 0.25, [brute_force(w, weights) for w in WORDS])


def test_a_very_long_word_is_worked_out_by_stretches():
    weights = np.random.default_rng(2).standard_normal(toxicity.SYMBOLS**3)
    model = toxicity.Model(weights, 0.0)
    word = "abcde" * 40_000
    word_, code, weight = toxicity.subsequences([word])
    assert np.isclose(model.values([word])[0], (weights[code] * weight).sum())


def test_scores_of_odd_tables(spark, monkeypatch):
    model = toxicity.Model(np.random.default_rng(3).standard_normal(toxicity.SYMBOLS**3), -0.5)
    rows = [(1, "some words", 7.0), (2, None, 7.0), (3, "", 7.0), (None, "some words", 7.0), (1, "some words", 7.0)]
    # a given column may have the name of the score
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity double")
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "toxicity"]
    got = [(r.doc_id, r.toxicity) for r in out.collect()]
    assert len(got) == 5 and len({s for i, s in got if i in (1, None)}) == 1
    assert got[1][1] == got[2][1] and all(0 <= s <= 1 for _, s in got)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert {r.toxicity for r in toxicity.score(docs, None).collect()} == {0.0}
