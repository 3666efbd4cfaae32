"""Decontamination against brute force, short items, and texts independent of their neighbours."""

import random

import numpy as np
import pytest

from tillstar.llm import decontaminate


def brute(texts, items, edits):
    """Every (text, item, distance) by the whole edit distance table."""
    out = set()
    for t, text in enumerate(texts):
        words = decontaminate.tokens(text)
        for i, item in items:
            wanted = decontaminate.tokens(item)
            row = [0] * (len(words) + 1)
            for n, word in enumerate(wanted, 1):
                new = [n]
                for j, other in enumerate(words, 1):
                    new.append(min(row[j - 1] + (word != other), row[j] + 1, new[-1] + 1))
                row = new
            if wanted and min(row) <= int(edits * len(wanted)):
                out.add((t, i, min(row)))
    return out


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = b"x%d" % rng.randrange(99)
        elif kind == 1:
            words.insert(at, b"y%d" % rng.randrange(99))
        else:
            del words[at]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_with_edits_equal_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))).encode()) for i in range(40)]
    texts = []
    for i, item in items:
        words = decontaminate.tokens(item)
        body = edited(rng, words, rng.randrange(int(0.2 * len(words)) + 1))
        before, after = (" ".join(rng.choices(vocabulary, k=rng.randrange(40))).encode() for _ in range(2))
        texts.append(b" ".join([before, *body, after]))
    bench = decontaminate.prepare(items)
    found = decontaminate.find(texts, bench)
    got = {(t, bench.ids[k], d) for t, held in enumerate(found) for k, (d, _) in held.items()}
    assert got == brute(texts, items, decontaminate.EDITS)


def test_short_items_stand_word_by_word():
    bench = decontaminate.prepare([(1, b"To be or not"), (2, b"quux"), (3, b"..."), (4, b"")])
    texts = [b"say: to be, or not!", b"to be or", b"quux", b"", None, b"to be and or not", b"a QUUX."]
    found = decontaminate.find(texts, bench)
    assert [sorted(bench.ids[k] for k in held) for held in found] == [[1], [], [2], [], [], [], [2]]
    assert decontaminate.prepare([(3, b"..."), (4, b"")]).sizes == []


def test_a_text_finds_the_same_whatever_stands_beside_it():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=20)).encode()) for i in range(10)]
    texts = [b" ".join(edited(rng, decontaminate.tokens(items[i % 10][1]), 6)) for i in range(60)]
    bench = decontaminate.prepare(items)
    assert decontaminate.find(texts, bench) == [decontaminate.find([t], bench)[0] for t in texts]


def test_a_long_item_costs_short_texts_nothing():
    words = [f"w{i}" for i in range(5000)]
    bench = decontaminate.prepare([(1, " ".join(words).encode())])
    texts = [b"w1 w2 w3 w4 w5 w6"] * 1000 + [" ".join(words[:2500] + ["x"] * 900 + words[2500:]).encode()]
    found = decontaminate.find(texts, bench)
    assert not any(found[:-1]) and found[-1][0][0] == 900
    line, origin = decontaminate._reached(np.arange(100), np.array([3, 50]), 4)
    assert line.tolist() == [3, 4, 5, 6, 7, 50, 51, 52, 53, 54] and origin.tolist() == [0, 5]


@pytest.mark.parametrize("n", [15, 30, 55])
def test_recall_at_the_largest_distance(n):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(600)]
    filler = lambda: " ".join(rng.choices(vocabulary, k=30)).encode()
    items = [(i, " ".join(rng.choices(vocabulary, k=n)).encode()) for i in range(200)]
    texts = [b" ".join([filler(), *edited(rng, t.split(), int(0.2 * n)), filler()]) for _, t in items]
    bench = decontaminate.prepare(items)
    found = decontaminate.find(texts, bench)
    assert sum(i in {bench.ids[k] for k in held} for i, held in enumerate(found)) >= 0.98 * len(items)
