"""Whitening against numpy over the distinct vectors, with exact whole-number sums."""

from __future__ import annotations

import numpy as np
import pytest

from tillstar.llm import whitening

pytest.importorskip("public_tokenizers")

SCHEMA = "vec_id long, embedding array<double>, key string, n int"


def table(spark, rows):
    """Rows of (vec_id, vector) with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, v, "k", 0) for i, v in rows], SCHEMA)


def whole(vectors):
    return np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000


def expected(fit_list, x):
    n, s = len(fit_list), fit_list.sum(axis=0)
    y = (n * fit_list - s) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1][:16], v[:, ::-1][:, :16]
    return ((n * x - s) ** 2).sum(axis=1), (n * x - s) / n @ v / np.sqrt(e), e / np.trace(y.T @ y / n)


@pytest.mark.parametrize("d", [3, 20])
@pytest.mark.parametrize("by_copies", [False, True])
def test_equals_numpy(spark, d, by_copies):
    rng = np.random.default_rng(d)
    distinct = rng.standard_normal((60, d)) * np.linspace(1, 3, d)
    # the first vector has a third of all rows; the last one comes twice
    vectors = np.concatenate([np.repeat(distinct[:1], 30, axis=0), distinct, distinct[-1:]])
    out = whitening.whiten(table(spark, enumerate(vectors.tolist())), by_copies).orderBy("vec_id").collect()
    x = whole(vectors)
    fit_list = x if by_copies else np.unique(x, axis=0)
    deviations, whitened, explained = expected(fit_list, x)
    assert [r.vec_id for r in out] == list(range(len(x)))
    assert {r.n for r in out} == {len(fit_list)}
    assert [int(r.deviation) for r in out] == deviations.tolist()
    got = np.array([r.whitened for r in out])
    sign = np.sign((got * whitened).sum(axis=0))
    assert np.allclose(got * sign, whitened, atol=1e-9)
    assert np.allclose(out[0].explained, explained, rtol=1e-9)
    assert {r.identity_error for r in out} and max(r.identity_error for r in out) < 1e-9


def test_rows_that_hold_no_vector_take_no_part(spark):
    bad = [None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1.0]]
    good = [[1.0, 2.0], [1.0, 2.0], [3.0, 1.0], [0.5, 0.25]]
    rows = [*enumerate(bad), (7, good[0]), (7, good[1]), (None, good[2]), (9, good[3])]
    out = whitening.whiten(table(spark, rows)).collect()
    assert sorted(str(r.vec_id) for r in out) == ["7", "7", "9", "None"]
    assert len({tuple(r.whitened) for r in out if r.vec_id == 7}) == 1


def test_lengths_are_spaces_of_their_own(spark):
    two = [[1.0, 2.0], [2.0, 5.0], [4.0, 1.0]]
    rows = [*enumerate(two), (10, [1.0, 2.0, 3.0]), (11, [])]
    out = {r.vec_id: r for r in whitening.whiten(table(spark, rows)).collect()}
    alone = {r.vec_id: r for r in whitening.whiten(table(spark, enumerate(two))).collect()}
    assert all(out[i] == alone[i] for i in range(3))
    # one vector has no variance, an empty one no component
    assert out[10].whitened == [None] * 3 and out[10].explained == [None] * 3 and out[10].deviation == 0
    assert out[11].whitened == []


def test_large_entries_stay_exact(spark):
    vectors = [[1e14, 1.0], [-1e14, 2.0], [3.0, 4.0]]
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x)]
    out = whitening.whiten(table(spark, enumerate(vectors))).orderBy("vec_id").collect()
    assert [int(r.deviation) for r in out] == [sum((3 * a - b) ** 2 for a, b in zip(v, s)) for v in x]


def test_no_vectors(spark):
    assert whitening.whiten(table(spark, [])).collect() == []


def test_query_gives_a_row_per_component(spark):
    from pathlib import Path

    from tillstar.llm.queries import op12_whitening

    data = "/root/testdata/sf0.001"
    Path(data).exists() or pytest.skip("no driver tables")
    vectors = spark.read.parquet(f"{data}/embeddings.parquet")
    out = op12_whitening(spark, data)
    kinds = dict(out.dtypes)
    assert [kinds[c] for c in ("vec_id", "component", "n", "deviation")] == ["bigint", "int", "bigint", "bigint"]
    assert [kinds[c] for c in ("whitened", "explained", "identity_error")] == ["double"] * 3
    rows = out.collect()
    assert len(rows) == 16 * vectors.count() and {r.component for r in rows} == set(range(1, 17))
    assert max(r.identity_error for r in rows) < 1e-4
    x = whole([r.embedding for r in vectors.orderBy("vec_id").collect()])
    deviations = expected(np.unique(x, axis=0), x)[0]
    got = {r.vec_id: r.deviation for r in rows}
    assert [got[i] for i in sorted(got)] == deviations.tolist()
