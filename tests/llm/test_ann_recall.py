"""Recall of the vector search on data without clusters, and ids that repeat across lists."""

from __future__ import annotations

import numpy as np

from tillstar.llm import ann


def vectors_of(spark, rows):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")


def test_probes_reach_the_recall_on_isotropic_vectors(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((8000, 32))
    index = ann.build(vectors_of(spark, enumerate(v)), lists=160)
    asked = index.vectors.filter("vec_id % 50 = 0").select("vec_id", "v")
    found = ann.search(index, asked).collect()
    assert ann.PROBES < index.probes <= 160
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    true = {}
    for q in range(0, 8000, 50):
        score = u @ u[q]
        score[q] = -np.inf
        true[q] = set(np.argsort(-score)[:5].tolist())
    for row in found:
        hits += row["vec_id"] in true[row["query_id"]]
        assert abs(row["score"] - u[row["query_id"]] @ u[row["vec_id"]]) < 1e-12
    assert len(found) == 5 * len(true)
    assert hits >= 0.9 * len(found)
    fewer = {(r["query_id"], r["vec_id"]) for r in ann.search(index, asked, probes=8).collect()}
    assert sum(v in true[q] for q, v in fewer) < hits


def test_probes_of_clustered_vectors_stay_few(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((60, 16))[rng.integers(0, 60, 4000)] + 0.05 * rng.standard_normal((4000, 16))
    index = ann.build(vectors_of(spark, enumerate(v)), lists=100)
    assert ann.lists_to_probe(index, 5) == ann.PROBES


def test_an_id_in_several_lists_has_one_rank(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((300, 8))
    rows = [(i % 20, x) for i, x in enumerate(v)]
    index = ann.build(vectors_of(spark, rows), lists=30)
    found = ann.search(index, index.vectors.filter("vec_id = 0").select("vec_id", "v")).collect()
    assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
    assert len({r["vec_id"] for r in found}) == 5
    assert 0 not in {r["vec_id"] for r in found}


def test_one_id_for_all_rows(spark):
    v = np.ones((50, 4)) + np.arange(50)[:, None]
    index = ann.build(vectors_of(spark, [(7, x) for x in v]))
    assert ann.search(index, index.vectors.select("vec_id", "v")).count() == 0
