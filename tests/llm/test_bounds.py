"""Plans, filters, files and lists that must not grow with the rows."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from tillstar.llm import common, line_dedup, toxicity
from tillstar.llm.common import may_be_in, stored


def test_filter_misses_nothing_and_is_no_literal(spark):
    ids = spark.range(0, 3000, 3).select((F.col("id") * 10**9).alias("doc_id"))
    asked = spark.range(0, 3000).select((F.col("id") * 10**9).alias("doc_id"))
    kept = asked.filter(may_be_in(ids, "doc_id"))
    got = {r[0] for r in kept.collect()}
    assert got >= {r[0] for r in ids.collect()} and len(got) < 1100
    # twice in one plan, negated, and with no ids at all
    touched = may_be_in(ids, "doc_id")
    assert asked.filter(touched).union(asked.filter(~touched)).count() == 3000
    assert asked.filter(may_be_in(ids.limit(0), "doc_id")).isEmpty()
    assert len(kept._jdf.queryExecution().toString()) < 50_000


def test_filter_takes_other_keys(spark):
    ids = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    rows = spark.createDataFrame([("a",), ("c",), (None,)], "x string")
    got = {r[0] for r in rows.filter(may_be_in(ids, "k", F.col("x"))).collect()}
    assert got >= {"a", None} and len(got) <= 3


def test_scratch_tables_leave_no_mark(spark):
    found = stored(spark, spark.range(10), "few")
    folder = Path(found.inputFiles()[0].removeprefix("file://")).parent
    assert found.count() == 10 and not (folder / "_SUCCESS").exists()


def test_words_in_context_come_in_small_batches():
    texts = [f"a{i} b c" for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": [i % 2 for i in range(300)]})
    out = list(toxicity.in_context([batch]))
    assert max(len(b) for b in out) <= 3 * toxicity.AT_ONCE
    rows = {(r["word"], r["before"], r["toxic"]) for b in out for r in b.to_pylist()}
    assert len(rows) == 602 and {("a5", "", 1), ("b", "a5", 1), ("c", "b", 0)} <= rows


def test_only_wanted_lines_are_cut_again(spark, monkeypatch):
    lines = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(300)]
    near = lines[7].replace("w7x8", "other")
    coded, sets = [], line_dedup._sets
    monkeypatch.setattr(line_dedup, "_sets", lambda rows, rarity: coded.append(rows.count()) or sets(rows, rarity))
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, f"{near}\n{lines[5]}")], "doc_id long, text string")
    got = {r["doc_id"]: r["lines"] for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {2: [0, 1]}
    assert coded[0] == 302 and len(coded) > 1 and max(coded[1:]) < 20


def test_words_of_a_line_are_plain_numbers_cut_from_whole_texts(spark):
    docs = spark.createDataFrame([(1, "the  cat\tthe dog\n\n the"), (None, "lost")], "doc_id long, text string")
    rarity = line_dedup._rarity(docs)
    classes = spark.sql(f"select {rarity} r").first()["r"]
    assert sorted(c for c in classes if c) == [3] and len(classes) == 1 << 16  # "the" comes three times
    sets = line_dedup._sets(line_dedup._lines(docs), rarity)
    kinds = {f.name: f.dataType for f in sets.schema}
    assert not kinds["words"].containsNull and not kinds["hashes"].containsNull
    got = {r["line"]: r for r in sets.collect()}
    assert {k: len(r["words"]) for k, r in got.items()} == {0: 3, 2: 1}
    assert got[0]["words"] == sorted(got[0]["words"]) and got[0]["words"][-1] == got[2]["words"][0]


def test_lines_around_the_size_of_a_narrow_sketch_equal_brute_force(spark):
    pick = random.Random(9)
    base = [f"w{i}" for i in range(90)]
    sets = []
    for _ in range(120):
        size, start = pick.randrange(50, 86), pick.randrange(4)
        some = base[start : start + size] + [f"x{pick.randrange(10**6)}" for _ in range(pick.randrange(9))]
        pick.shuffle(some)
        sets.append(some)
    docs = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(sets)], "doc_id long, text string")
    got = {r["doc_id"] for r in line_dedup.repeated_lines(docs).collect()}
    sets = [set(s) for s in sets]
    want = {i for i, a in enumerate(sets) if any(10 * len(a & b) >= 8 * len(a | b) for b in sets[:i])}
    assert got == want and 0 < len(want) < 119


def test_lines_by_their_white_space(spark):
    texts = ["a\tb  c\x0b\x0cd\r", "D c b a\n \t\r\n\n a  b c d ", "\xa0\n \n\xa0", " a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["lines"] for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {1: [0, 3], 2: [2], 3: [0]}


def test_workers_give_memory_back(monkeypatch):
    asked = []

    class Pool:
        def release_unused(self):
            asked.append("arrow")

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"text": ["a b", "b"], "toxic": [1, 0]})
    out = common.released(toxicity.in_context)([batch])
    first = next(out)
    assert not asked and first.num_rows == 3
    assert not list(out) and asked == ["arrow"]
