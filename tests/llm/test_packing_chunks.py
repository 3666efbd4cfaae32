"""Chunks of texts against the tokenizer itself, and what is encoded of them."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

path = pytest.importorskip("public_tokenizers").path

from tillstar.llm import packing  # noqa: E402


@pytest.fixture
def encoder() -> packing.Encoder:
    return packing.Encoder(path("byte_bpe_50k.json"))


def test_chunks_of_odd_texts_give_the_tokenizers_ids(encoder):
    letters = "abZz'sdtreé ßñøÿ×÷ªµº.,;:!?_-`~{}[]@/\\\"#019²½Ⅷ   \n\t\r  　中文бя́‍🙂\x1c\x1f\x85Āſ%&"
    pick = random.Random(4)
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(40))) for _ in range(4000)]
    want = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    for _ in range(2):  # the second time from the cache
        assert list(encoder.encode([None, *texts])) == [b"", *map(encoder._ids, want)]


def test_words_before_different_marks_are_encoded_once(encoder, monkeypatch):
    encoded, plain = [], encoder._chunks

    def chunks(some):
        encoded.extend(some)
        return plain(some)

    monkeypatch.setattr(encoder, "_chunks", chunks)
    list(encoder.encode(["so qelbra. qelbra, qelbra; (qelbra) qelbra", "qelbra! qelbra qelbra?"]))
    assert encoded.count(" qelbra") == 1 and not [c for c in encoded if c.startswith(" qelbra") and c != " qelbra"]


def test_what_leaves_the_cache_is_found_among_the_older(encoder, monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 2)
    first = list(encoder.encode(["one two three four"]))
    encoded, plain = [], encoder._chunks
    monkeypatch.setattr(encoder, "_chunks", lambda some: encoded.extend(some) or plain(some))
    assert list(encoder.encode(["one two three four"])) == first and encoded == []


def test_few_texts_are_held_at_once(encoder, monkeypatch):
    texts = [f"text {i} of many" if i % 7 else None for i in range(2000)]
    held, plain = [], encoder.encode
    monkeypatch.setattr(encoder, "encode", lambda some: held.append(len(some)) or plain(some))
    monkeypatch.setattr(packing.Encoder, "of", lambda file: encoder)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": texts})
    out = [r for b in packing.cut([batch, batch.slice(0, 0)], "", 4, 1) for r in b.to_pylist()]
    assert sum(held) == 2000 and max(held) <= 256
    want = [len(ids) // 4 + 1 for ids in plain(texts)]
    assert [(r["doc_id"], r["start"]) for r in out] == [(i, at) for i, n in enumerate(want) for at in range(0, n, 4)]
    assert all(r["doc_tokens"] == want[r["doc_id"]] for r in out)
