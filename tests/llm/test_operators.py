"""Each corpus operator on small tables with nulls, empty texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tillstar.llm import (
    ann,
    class_lm,
    decontaminate,
    language,
    line_dedup,
    near_duplicates,
    packing,
    token_counts,
    toxicity,
    warc,
)

tokenizers = pytest.importorskip("public_tokenizers")

DOC = "doc_id long, text string, set string, row string"


def docs(spark, texts, start=0):
    """Documents with columns whose names some operators use themselves."""
    return spark.createDataFrame([(start + i, t, "s", "r") for i, t in enumerate(texts)], DOC)


def text_of(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


def test_nearest_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(60)]
    rows += [(60, rows[0][1]), (61, None), (62, [0.0] * 8), (63, [float("nan")] * 8), (64, [None] * 8), (None, rows[1][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.build(vectors)
    asked = index.vectors.filter("vec_id % 50 = 0").select("vec_id", "v")
    got = {(r[0], r[1]): r[2] for r in ann.search(index, asked).collect()}
    v = np.array([r[1] for r in rows[:61]])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in (0, 50):
        score = u @ u[q]
        order = [j for j in np.lexsort((np.arange(61), -np.round(score, 12))) if j != q][:5]
        assert [got[q, k] for k in range(1, 6)] == order


def test_no_usable_vector_gives_no_index(spark):
    assert ann.build(spark.createDataFrame([], "vec_id long, embedding array<float>")) is None


def test_repeated_lines(spark):
    base = "one two three four five six seven eight nine ten"
    near = base.replace("ten", "eleven")
    texts = [f"{base}\nalone here", f"{near}\n\nalone here", None, "", base, "ten two three four five six seven eight nine one"]
    got = [r[0] for r in line_dedup.dedup_lines(docs(spark, texts)).orderBy("doc_id").select("text").collect()]
    assert got == [texts[0], "", None, "", "", ""]


def test_repeated_lines_equal_brute_force(spark):
    rng = random.Random(3)
    lines = [text_of(rng, rng.randrange(1, 25), 60) for _ in range(40)]
    lines += [" ".join(l.split()[:-1] + ["odd"]) for l in lines[:20]]
    texts = ["\n".join(rng.choice(lines) for _ in range(4)) for _ in range(30)]
    want, seen = {}, []
    for i, text in enumerate(texts):
        for n, line in enumerate(text.split("\n")):
            words = frozenset(line.split())
            if any(100 * len(words & s) >= 80 * len(words | s) for s in seen):
                want.setdefault(i, []).append(n)
            seen.append(words)
    got = {r[0]: r[1] for r in line_dedup.repeated_lines(docs(spark, texts)).collect()}
    assert got == want


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_archives_give_back_what_went_in(spark):
    big = "<p>" + "text " * 300
    pages = [(1, "http://a b/\n", big), (2, None, big), (3, "u", None), (4, "u", "small"), (5, "u", "small"), (None, "u", big)]
    pages += [(10 + i, f"http://h/{i}", f"<html>{i}" * 200) for i in range(60)]
    manifest = warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string"))
    back = warc.read_archives(manifest).withColumn("id", warc.page_id("record_id"))
    got = {r["id"]: r for r in back.withColumn("ref", warc.page_id("refers_to")).collect()}
    assert len(got) == len(pages)
    for page, _, html in pages:
        payload = (html or "").encode()
        assert got[page]["payload_digest"] == hashlib.sha1(payload).hexdigest()
        assert got[page]["payload_bytes"] == len(payload)
        revisit = page in (1, None)
        assert (got[page]["record_type"], got[page]["ref"]) == (("revisit", 2) if revisit else ("response", None))
        if not revisit:
            assert bytes(got[page]["payload"]) == payload


def test_class_model_counts_and_beats_single_words(spark):
    rng = random.Random(5)
    texts = [" ".join(f"{a}{rng.randrange(9)}" for _ in range(20) for a in ("a", "b", "c")) for _ in range(60)]
    texts += [None, "", "Never SEEN"]
    model = class_lm.train(docs(spark, texts[:60]))
    rows = class_lm.score(docs(spark, texts), model).orderBy("doc_id").collect()
    counts = Counter(w for t in texts[:60] for w in t.split()) | Counter({"": 60})
    n, v = sum(counts.values()), len(counts)
    for row, text in zip(rows, texts):
        words = [*(text or "").lower().split(), ""]
        assert (row["n_tokens"], row["train_tokens"]) == (len(words), n)
        assert row["n_known"] == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert row["base_score"] == pytest.approx(base)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_class_model_of_nothing(spark):
    model = class_lm.train(docs(spark, []))
    assert class_lm.score(docs(spark, ["a b", None]), model).filter("isnan(score)").count() == 0


TRICKY = [None, "", " ", "  a  b ", "a\n\nb\n", "<|endoftext|> </s>", "▁x é", "日本 x　y", "\x1c\x85z", "don't  we'll", "x" * 5000]


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    file = tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    rows = token_counts.token_counts(docs(spark, TRICKY), file).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == [len(library.encode(t or "")) for t in TRICKY]
    assert [r["n_bytes"] for r in rows] == [len((t or "").encode()) for t in TRICKY]


def test_packing_keeps_every_id_once(spark):
    from tokenizers import Tokenizer

    file = tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    rng = random.Random(7)
    texts = TRICKY + [text_of(rng, rng.randrange(1, 900)) for _ in range(40)]
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    rows = packing.pack(docs(spark, texts), file).collect()
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"]
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends[r["sequence_id"]] == r["offset"]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048


def test_plan_places_every_length():
    histogram = {2048: 3, 1500: 5, 548: 7, 10: 100}
    patterns = packing.plan(histogram, 2048)
    placed = Counter()
    for p in patterns:
        assert p.used <= 2048
        for length, repeats in p.runs:
            placed[length] += repeats * p.count
    assert placed == histogram


def test_toxicity_finds_gapped_insults(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = text_of(rng, 30).split()
        if i % 5 == 0:
            words.insert(rng.randrange(30), rng.choice(["moron", "scum", "idiot"]))
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    model = toxicity.train(spark.createDataFrame(rows + [(400, None, 1), (401, "x", None)], "doc_id long, text string, toxic int"))
    texts = ["w1x w2x moron", "w1x you IDIOT!!", "w5x mo-ron w7x", "w1x w2x w3x", None, ""]
    got = [r[0] for r in toxicity.score(docs(spark, texts), model).orderBy("doc_id").select("toxicity").collect()]
    assert all(x >= 0.3 for x in got[:3]) and all(x < 0.3 for x in got[3:])


def test_toxicity_without_labels(spark):
    assert toxicity.train(spark.createDataFrame([], "doc_id long, text string, toxic int")) is None
    assert toxicity.score(docs(spark, ["a"]), None).first()["toxicity"] == 0.0


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        base = text_of(rng, 120).split()
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    hot = text_of(rng, 120).split()
    texts += [" ".join(hot[:i] + [f"h{i}"] + hot[i + 1 :]) for i in range(70)]
    texts += [None, "", " ", "a b", "A  B", "a"]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    root = list(range(len(texts)))
    for _ in root:
        for i, a in enumerate(sets):
            for j in range(i):
                if a and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    rows = near_duplicates.near_duplicates(docs(spark, texts), 85, 3).orderBy("doc_id").collect()
    assert [r["component_id"] for r in rows] == root
    assert [r["n_shingles"] for r in rows] == [len(s) for s in sets]


def test_decontamination_finds_edited_passages(spark):
    rng = random.Random(13)
    items = [text_of(rng, n, 5000) for n in (14, 30, 55)] + ["too few words", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    edited = items[1].split()
    edited[5], edited[20] = "typo", "other"
    del edited[12]
    filler = lambda: text_of(rng, 80, 5000)
    texts = [f"{filler()} {items[0]} {filler()}", f"{filler()} {' '.join(edited)}", items[2].upper(), filler(), None, "", items[1][:60]]
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contamination(docs(spark, texts), bench).collect()}
    assert got == {(0, 0): 0, (1, 1): 3, (2, 2): 0}
    kept = decontaminate.clean(docs(spark, texts), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]


def test_language_identification(spark):
    rng = random.Random(15)
    say = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(12))
    rows = [(i, say("abcde") if i % 2 else say("vwxyz"), "l1" if i % 2 else "l2") for i in range(60)]
    model = language.train(spark.createDataFrame(rows + [(60, None, "l1"), (61, "abc", None)], "doc_id long, text string, lang string"))
    texts = [say("abcde"), say("vwxyz"), None, "", "12 !"]
    got = language.identify(docs(spark, texts), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["l1", "l2", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in got)
