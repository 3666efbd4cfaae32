"""Document statistics against plain counting, the fit against one solve over all rows."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.llm import quality_classifier as q

pytest.importorskip("public_tokenizers")

AT = {name: i for i, name in enumerate(q.STATISTICS)}


def prose(rng, n=60):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8))) for _ in range(n)) + "."


def junk(rng, n=60):
    word = prose(rng, 1)
    return " | ".join([word] * n)


def test_statistics_equal_plain_counts():
    texts = ["The cat sat.\nThe cat sat.\nno | 42 WORDS here\x01 é", "a a b a", " \n ", "", None]
    rows = q.statistics_of([None if t is None else t.encode() for t in texts])
    first = rows[0]
    words = texts[0].split()
    size = len(texts[0].encode())
    assert first[AT["log_bytes"]] == np.log1p(size)
    assert first[AT["log_words"]] == np.log1p(len(words))
    assert first[AT["word_length"]] == np.mean([len(w.encode()) for w in words])
    assert np.isclose(first[AT["word_length_sd"]], np.std([len(w.encode()) for w in words]))
    assert first[AT["digits"]] == 2 / size and first[AT["controls"]] == 1 / size
    assert first[AT["words_without_letters"]] == 2 / len(words)
    assert first[AT["capital_words"]] == 1 / len(words)
    assert first[AT["sentence_ends"]] == 2 / len(words)
    assert first[AT["lines_as_last"]] == 1 / 3
    assert rows[1][AT["words_as_last"]] == 1 / 4
    assert rows[1][AT["words_as_last_but_one"]] == 1 / 4
    assert rows[1][AT["distinct_in_window"]] == 2 / 4
    # null, empty and blank texts are defined; null is as empty
    assert np.isfinite(rows).all() and (rows[3] == rows[4]).all() and (rows[3] == 0).all()


def test_long_texts_go_by_pieces(monkeypatch):
    rng = random.Random(1)
    text = "\n".join(prose(rng, 9) for _ in range(200)).encode()
    whole = q.statistics_of([text, b"x", text])
    monkeypatch.setattr(q, "PIECE", 1000)
    assert b"".join(q._pieces(text)) == text and max(map(len, q._pieces(text))) <= 1000
    cut = q.statistics_of([text, b"x", text])
    assert (cut[0] == cut[2]).all() and (cut[1] == whole[1]).all()
    # a cut ends a line and a window; everything else adds up
    apart = [AT[n] for n in ("distinct_in_window", "words_as_last", "words_as_last_but_one", "log_line_words", "lines_as_last", "short_lines")]
    assert np.allclose(np.delete(cut, apart, 1), np.delete(whole, apart, 1))
    assert np.allclose(cut[0][apart], whole[0][apart], atol=0.05)
    # without white space a word is cut, and nothing is lost
    assert q.statistics_of([b"x" * 5500])[0][AT["log_bytes"]] == np.log1p(5500)


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        n = rng.integers(1, 9)
        w = rng.integers(1, 4, n).astype(float)
        y = rng.integers(0, 2, n) * w
        knots, levels = q.isotonic(np.arange(n, dtype=float), y, w)
        # max-min formula of isotonic regression
        want = [max(min(y[a : b + 1].sum() / w[a : b + 1].sum() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        got = [levels[np.searchsorted([want.index(x) for x in dict.fromkeys(want)], i, "right") - 1] for i in range(n)]
        assert np.allclose(got, want) and (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng) if i % 3 else junk(rng), "x", 1.0) for i in range(240)]
    rows += [(240, None, "x", 1.0), (241, "", "x", 1.0), (None, "some words", "x", 1.0), rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats string, score double")
    labels = [(i, int(i % 3 > 0)) for i in range(0, 240, 2)] + [(None, 1), (2, None), (4, 7), (999, 0), (6, 1), (6, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, label int")


def test_fit_equals_one_solve_over_all_rows(spark, corpus):
    docs, labels = corpus
    stats = q.statistics(docs)
    model = q.train(stats, labels)
    kept = {r[0]: np.array(r[1]) for r in stats.collect()}
    known = [(kept[i], y) for i, y in [tuple(r) for r in labels.collect()] if i in kept and i is not None and y in (0, 1)]
    x, y = np.array([k[0] for k in known]), np.array([k[1] for k in known], float)
    z = model.features(x)
    held = np.eye(z.shape[1])
    held[-1, -1] = 0
    w = np.linalg.solve(z.T @ z + q.RIDGE * len(y) * held, z.T @ y)
    assert np.allclose(z @ w, z @ model.weights[:, -1], atol=1e-6)


def test_every_document_is_scored(spark, corpus):
    docs, labels = corpus
    stats = q.statistics(docs)
    out = q.score(stats, q.train(stats, labels))
    assert out.columns == ["doc_id", "score"]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == docs.count() and all(0 <= s <= 1 for _, s in rows)
    unseen = {i: s for i, s in rows if i is not None and i % 2 and i < 240}
    assert all((s >= 0.3) == (i % 3 > 0) for i, s in unseen.items())


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([(5000, 1)], 0.5)])
def test_labels_of_one_kind_or_none(spark, corpus, labels, want):
    stats = q.statistics(corpus[0])
    model = q.train(stats, spark.createDataFrame(labels, "doc_id long, label int"))
    assert {r[1] for r in q.score(stats, model).collect()} == {want}


def test_no_documents(spark, corpus):
    stats = q.statistics(corpus[0].limit(0))
    assert q.score(stats, q.train(stats, corpus[1])).count() == 0


def test_query_holds_a_fifth_out(spark):
    from tillstar.llm.queries import op11_quality

    data = "/root/testdata/sf0.001"
    Path(data).exists() or pytest.skip("no driver tables")
    out = op11_quality(spark, data)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    wrong = out.filter((F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0)) | (F.col("predicted") != (F.col("score") >= 0.3).cast("int")))
    assert wrong.count() == 0
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality")
    judged = out.filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert judged is None or judged > 0.8
