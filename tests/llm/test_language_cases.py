"""Texts without letters, and tables with clashing columns."""

from __future__ import annotations

import pytest

from tillstar.llm import language

pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("text, expected", [
    ("½ ²", False), ("Ⅷ ٣ 12_3", False), ("", False), (None, False), ("½ a", True), ("ß", True), ("字", True), ("ª", True),
])
def test_only_letters_count(text, expected):
    assert language.has_letter(text) is expected


def test_und_and_clashing_columns(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(20)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [(1, "½ ²", 5), (2, None, 5), (3, "the dog", 5), (3, "the dog", 5), (None, "der hund", 5)]
    docs = spark.createDataFrame(asked, "doc_id long, text string, score int").selectExpr("*", "1 AS lang_pred")
    out = language.identify(docs, model)
    assert sorted(out.columns) == ["doc_id", "lang_pred", "score"]
    got = [(r.doc_id, r.lang_pred) for r in out.collect()]
    assert got == [(1, "und"), (2, "und"), (3, "en"), (3, "en"), (None, "de")]
    assert language.identify(docs.limit(0), model).count() == 0
