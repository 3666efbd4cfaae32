"""Each stage of the pipeline against a plain version on its own input, and the chain."""

from __future__ import annotations

import zlib
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tillstar.llm.common import stored

tokenizers = pytest.importorskip("public_tokenizers")

DATA = Path("/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The given tables with planted rows: stage name to its output, and the input as 'documents'."""
    folder = tmp_path_factory.mktemp("tables")
    docs = pq.read_table(DATA / "documents.parquet")
    bench = pq.read_table(DATA / "benchmark.parquet")
    first = next(t for t in docs["text"].to_pylist() if t and len(t.split()) > 200)
    passage = next(t for t in bench["text"].to_pylist() if t and len(t.split()) > 8)
    texts = [None, "", first, first, f"quite another text\n{passage}\nand its end", passage]
    rows = {"doc_id": range(10**6, 10**6 + len(texts)), "text": texts, "lang": [None] * 6, "source": ["planted"] * 6, "n_chars": [0] * 6}
    more = pa.table({c: pa.array(list(rows[c]), docs.schema.field(c).type) for c in COLUMNS})
    pq.write_table(pa.concat_tables([docs.select(COLUMNS), more]), folder / "documents.parquet")
    for name in ("labels", "benchmark"):
        (folder / f"{name}.parquet").symlink_to(DATA / f"{name}.parquet")
    found = spark.read.parquet(f"{folder}/documents.parquet")
    out = {"documents": found.collect()}
    for name, stage in corpus_pipeline.STAGES:
        found = stored(spark, stage(spark, found, str(folder)), name)
        if name != "packing":
            assert found.columns == COLUMNS
        out[name] = found.collect()
    return out


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_toxic_documents_go(stages):
    given, kept = by_id(stages["documents"]), by_id(stages["toxicity"])
    assert all(given[i] == row for i, row in kept.items())
    # the table has nine toxic rows to learn from, so a few errors on it are due
    labels = pq.read_table(DATA / "labels.parquet").to_pylist()
    toxic, clean = ([r["doc_id"] for r in labels if r["doc_id"] in given and r["toxic"] == x] for x in (1, 0))
    assert sum(i not in kept for i in toxic) >= 0.8 * len(toxic)
    assert sum(i in kept for i in clean) >= 0.9 * len(clean)
    assert {10**6, 10**6 + 1} <= kept.keys()


def test_repeated_lines_go(stages):
    seen: list[frozenset[str]] = []
    want = {}
    for row in sorted(stages["toxicity"], key=lambda r: r["doc_id"]):
        if row["text"] is None:
            want[row["doc_id"]] = None
            continue
        kept = []
        for line in row["text"].split("\n"):
            words = frozenset(w for w in line.lower().replace("\x0b", " ").replace("\x0c", " ").split() if w)
            near = [s for s in seen if 5 * min(len(s), len(words)) >= 4 * max(len(s), len(words))]
            if not words or not any(100 * len(words & s) >= 80 * len(words | s) for s in near):
                kept.append(line)
            if words:
                seen.append(words)
        want[row["doc_id"]] = "\n".join(kept)
    got = {r["doc_id"]: r["text"] for r in stages["line_dedup"]}
    assert got.keys() == want.keys()
    differ = [i for i in want if got[i] != want[i]]
    assert not differ


def test_one_of_each_group_stays(stages):
    sets = {}
    for row in stages["line_dedup"]:
        w = (row["text"] or "").lower().split()
        sets[row["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    assert {r["doc_id"] for r in stages["near_duplicates"]} == {i for i in ids if top(i) == i}


def test_benchmark_passages_go(stages):
    given, kept = by_id(stages["near_duplicates"]), by_id(stages["decontamination"])
    assert all(given[i] == row for i, row in kept.items())
    items = [tuple(t.lower().split()) for t in pq.read_table(DATA / "benchmark.parquet")["text"].to_pylist() if t and t.split()]
    for i, row in given.items():
        w = (row["text"] or "").lower().split()
        held = any(tuple(w[at : at + len(item)]) == item for item in items for at in range(len(w) - len(item) + 1) if w[at] == item[0])
        assert not (held and i in kept)
    assert 10**6 + 1 in kept or 10**6 + 1 not in given


def test_packs_hold_every_id_once(stages):
    tokenizer = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    pieces: dict[int, list] = {}
    for row in stages["packing"]:
        pieces.setdefault(row["doc_id"], []).append(row)
    assert pieces.keys() == {r["doc_id"] for r in stages["decontamination"]}
    for doc in stages["decontamination"]:
        ids = [*tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids, 1]
        at = 0
        for row in sorted(pieces[doc["doc_id"]], key=lambda r: r["start"]):
            data = b"".join(x.to_bytes(4, "little") for x in ids[at : at + row["length"]])
            assert (row["start"], row["ids_crc32"], row["doc_tokens"]) == (at, zlib.crc32(data), len(ids))
            at += row["length"]
        assert at == len(ids)
    packs: dict[int, list] = {}
    for row in stages["packing"]:
        packs.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in packs.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
