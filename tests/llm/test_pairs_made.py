"""Pairs of alike documents that the near-duplicate join makes."""

from __future__ import annotations

import numpy as np

from tillstar.llm import near_duplicates


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(5)
    for n, changed in ((30, 1), (200, 20), (200, 150), (5000, 40)):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)]))
        x, y = near_duplicates.parity_sketch(a), near_duplicates.parity_sketch(b)
        different = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert len(x) * 64 == near_duplicates.SKETCH
        assert 0 < different <= len(np.setxor1d(a, b))


def test_alike_texts_below_the_threshold_make_few_pairs(spark, monkeypatch):
    """A large group whose texts share three quarters, with a few links among them."""
    rng, words = np.random.default_rng(7), 150
    base = [f"w{i}" for i in range(words)]
    texts = []
    for i in range(120):
        at = set(rng.choice(words, 7, replace=False).tolist())  # each takes three shingles with it
        texts.append(" ".join(f"x{i}y{j}" if j in at else w for j, w in enumerate(base)))
    texts += [t + f" end{i}" for i, t in enumerate(texts[:5])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(near_duplicates.shingles(t.encode(), 3).tolist()) for t in texts]
    links = [(i, j) for i in range(125) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert 5 <= len(links) < 100
    made = []
    pairs = near_duplicates._Join._pairs

    def counted(self, rows):
        out = pairs(self, rows)
        made.append(out.distinct().count())
        return out

    monkeypatch.setattr(near_duplicates._Join, "_pairs", counted)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(docs, percent=85, width=3).collect()}
    assert made and max(made) < 500  # all pairs of the group are 7750
    for i in range(120, 125):
        assert found[i] == found[i - 120]
