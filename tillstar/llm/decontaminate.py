"""Benchmark decontamination by a random-walk embedding of edit distance.

The walk reads a sequence of words; at each step it writes the current word and moves on only
if a random bit of (step, word) says so. Two sequences at a small edit distance fall into step
again, so their outputs differ in few places: edit distance becomes Hamming distance. Each
repetition samples a few output places of every item-sized window as a key; keys that an item
shares are candidates, confirmed by the exact edit distance. Windows that lack too many words of
the benchmark can't be within the distance and are passed over without any loss. A walk stops
at the end of its text and writes words from then on that the benchmark lacks, as most of what
follows an item elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import as_bytes, few_rows, mix64, released

#: Edits allowed, as a share of an item's words; shorter items than this take no part.
EDITS, LEAST = 0.2, 1
#: Independent repetitions, and output places sampled in each: at the largest distance a place
#: agrees more than half of the time, so a pair is missed with probability under 0.3 %.
REPEATS, PLACES = 32, 3
#: Items of at most this ratio of lengths share their windows.
WIDTH = 1.2
#: Items that one pass over the texts looks for; more items take more passes.
ITEMS = 20_000
CHUNK = 1 << 21
#: Texts that a worker holds at once.
ROWS = 1024
#: Words that a worker keeps the code of, and the longest kept.
CACHED, LONGEST_CACHED = 300_000, 64
#: Codes: no word of the benchmark, the end of a text, nothing but punctuation.
OTHER, END, BLANK = 0, 1, 2

_EDGES = b".,;:!?\"'()[]{}<>-"


class Codes(dict):
    """The code of a white-space separated word: its number in the vocabulary, without
    punctuation around it."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: bytes) -> int:
        word = raw.strip(_EDGES)
        code = self.vocabulary.get(word, OTHER) if word else BLANK
        if len(raw) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.clear()
            self[raw] = code
        return code

    def of(self, text: bytes | None) -> np.ndarray:
        found = text.lower().split() if text else []
        codes = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        return codes[codes != BLANK]


def tokens(text: bytes | None) -> list[bytes]:
    """Words in lower case without punctuation around them."""
    if not text:
        return []
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]


@dataclass
class Size:
    """Items of about one length. Per repetition: places, and the items' keys, sorted, with a
    table of their low bits; items in the order of their keys."""

    least: int
    most: int
    needed: int
    exact: bool
    items: list[int] = field(default_factory=list)
    places: list[np.ndarray] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    order: list[np.ndarray] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)

    def matches(self, r: int, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """Of these keys (position, item) where an item has the same one."""
        known, low = self.keys[r], self.low[r]
        some = np.flatnonzero(low[keys & np.uint64(len(low) - 1)])
        first = np.searchsorted(known, keys[some], side="left")
        last = np.searchsorted(known, keys[some], side="right")
        for i in np.flatnonzero(last > first):
            for k in range(first[i], last[i]):
                yield int(some[i]), int(self.order[r][k])


@dataclass
class Benchmark:
    ids: list
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]
    sizes: list[Size]
    edits: float
    #: Per code a flag that is set for a moment only.
    mark: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def allowed(self, item: int) -> int:
        return int(self.edits * len(self.words[item]))

    def bits(self, r: int, block: int) -> np.ndarray:
        """Per code its random bits of 64 steps; the end never moves on."""
        codes = np.arange(len(self.vocabulary) + BLANK + 1, dtype=np.uint64)
        out = mix64(codes * np.uint64(0x100000001B3) + np.uint64((r * 1_000_003 + block) * 2 + 1))
        out[END] = 0
        return out


def walk_keys(
    line: np.ndarray, starts: np.ndarray, member: list[np.ndarray], sizes: list[Size], r: int, bench: Benchmark
) -> list[np.ndarray]:
    """Per size a key for each start that is a member there: the words written at its sampled
    places. All sizes share one walk from a start; it ends with the last place wanted there.
    """
    keys = [np.full(int(m.sum()), r, np.uint64) for m in member]
    last = [int(size.places[r][-1]) if len(key) else -1 for size, key in zip(sizes, keys)]
    wanted: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        for step in size.places[r].tolist():
            wanted.setdefault(step, []).append(i)
    said = np.where(line == END, OTHER, line).astype(np.uint64)
    at, walking, rows, bits = starts, None, {}, np.zeros(0, np.uint64)
    for step in range(max(last, default=-1) + 1):
        if step % 64 == 0:
            bits = bench.bits(r, step // 64)[line]
        left = [i for i in range(len(sizes)) if last[i] >= step]
        if left != walking:  # also makes a copy of the starts
            stays = np.logical_or.reduce([member[i] for i in left])
            at, member = at[stays], [m[stays] for m in member]
            rows = {i: np.flatnonzero(member[i]) for i in left}
            walking, move = left, np.empty(len(at), np.uint64)
        for i in wanted.get(step, []):
            if last[i] >= 0:
                keys[i] = mix64(keys[i] ^ (said[at[rows[i]]] + np.uint64(step * 0x9E3779B1 + 1)))
        # no place is out of range: a walk stops at an end, and line reaches as far as its steps
        np.take(bits, at, out=move, mode="clip")
        move >>= np.uint64(step % 64)
        move &= np.uint64(1)
        at += move.view(np.int64)
    return keys


def run_keys(line: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A key per start: the n words from there. line goes on for n words after every start."""
    key = np.zeros(len(starts), np.uint64)
    for step in range(n):
        key = mix64(key ^ (line[starts + step].astype(np.uint64) + np.uint64(step * 0x9E3779B1 + 1)))
    return key


def prepare(items: list[tuple], edits: float = EDITS, least: int = LEAST) -> Benchmark:
    """items: (id, text as bytes). Items of under `least` words, or without any, are left out.
    Items too short for a single edit are searched by all their words instead of a walk's."""
    kept = [(i, w) for i, t in items if len(w := tokens(t)) >= max(1, least)]
    vocabulary: dict[bytes, int] = {}
    words = [
        np.array([vocabulary.setdefault(x, len(vocabulary) + BLANK + 1) for x in w], np.int64)
        for _, w in kept
    ]
    out = Benchmark([i for i, _ in kept], words, vocabulary, [], edits)
    out.mark = np.zeros(len(vocabulary) + BLANK + 1, bool)
    rng = np.random.default_rng(5)
    for k in sorted(range(len(kept)), key=lambda k: len(words[k])):
        n = len(words[k])
        exact = int(edits * n) == 0
        if not out.sizes or n > WIDTH * out.sizes[-1].least or exact != out.sizes[-1].exact:
            out.sizes.append(Size(n, n, 0, exact))
        out.sizes[-1].items.append(k)
        out.sizes[-1].most = n
    for size in out.sizes:
        size.needed = size.least - int(edits * size.most)
        parts = [p for k in size.items for p in (words[k], [END])]
        line = np.concatenate(parts)
        starts = np.cumsum([0] + [len(words[k]) + 1 for k in size.items[:-1]])
        length = max(PLACES, int(1.6 * size.least))
        for r in range(1 if size.exact else REPEATS):
            size.places.append(np.sort(rng.choice(length, PLACES, replace=False)))
            if size.exact:
                keys = run_keys(line, starts, size.least)
            else:
                (keys,) = walk_keys(line, starts, [np.ones(len(starts), bool)], [size], r, out)
            order = np.argsort(keys, kind="stable")
            low = np.zeros(1 << max(10, (64 * len(keys) - 1).bit_length()), bool)
            low[keys & np.uint64(len(low) - 1)] = True
            size.keys.append(keys[order])
            size.order.append(np.array(size.items)[order])
            size.low.append(low)
    return out


def edit_distance(item: np.ndarray, text: np.ndarray, most: int | None = None) -> tuple[int, int]:
    """The least word edits between item and any stretch of text, and where that one ends. With
    `most`, any distance above it stands for a larger one."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[:-1] + (text != word), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - steps) + steps
        if most is not None and int(row.min()) > most:
            break
    end = int(row.argmin())
    return int(row[end]), end


def find(texts: list[bytes | None], bench: Benchmark, codes: Codes | None = None) -> list[dict[int, tuple[int, int]]]:
    """Per text the items found: least distance, and the first word of a window near it."""
    out: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    if not bench.sizes:
        return out
    codes = Codes(bench.vocabulary) if codes is None else codes
    parts, owners, firsts, at = [], [], [], 0
    fewest = min(size.needed for size in bench.sizes)
    for i, text in enumerate(texts):
        found = codes.of(text)
        if len(found) < fewest:
            continue
        parts += [found, [END]]
        owners.append(i)
        firsts.append(at)
        at += len(found) + 1
    if not parts:
        return out
    line, firsts = np.concatenate(parts), np.array(firsts)
    ends = np.append(firsts[1:], len(line)) - 1
    hits = np.concatenate([[0], np.cumsum(line > BLANK)])
    doc = np.repeat(np.arange(len(firsts)), ends + 1 - firsts)
    starts = []
    for size in bench.sizes:
        # a window ends where its text ends
        stop = np.minimum(np.arange(len(line)) + size.least, ends[doc])
        starts.append(np.flatnonzero(hits[stop] - hits[:-1] >= size.needed))
    seen: set[tuple[int, int, int]] = set()
    # sizes grow by WIDTH, so there are few of them
    walked = [i for i, size in enumerate(bench.sizes) if not size.exact]
    some = [bench.sizes[i] for i in walked]
    member = np.zeros((len(walked), len(line)), bool)
    for i, of in zip(walked, member):
        of[starts[i]] = True
    every = np.flatnonzero(member.any(axis=0))
    member = list(member[:, every])
    near, origin = _reached(line, every, max((int(p[-1]) for s in some for p in s.places), default=0))
    for r in range(REPEATS if walked else 1):
        found = dict(zip(walked, walk_keys(near, origin, member, some, r, bench)))
        for i, size in enumerate(bench.sizes if r == 0 else []):
            if size.exact:
                found[i] = run_keys(line, starts[i], size.least)
        for i, keys in found.items():
            size = bench.sizes[i]
            for k, item in size.matches(r, keys):
                start = int(starts[i][k])
                d = int(doc[start])
                # neighbouring windows meet the same stretch of text
                mark = (d, item, start // size.least)
                if mark in seen:
                    continue
                seen.add(mark)
                _confirm(line, firsts[d], ends[d], start, item, bench, out[owners[d]])
    return out


def _reached(line: np.ndarray, starts: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of line that walks of so many steps can reach, in a row, and the starts there."""
    edge = np.zeros(len(line) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + steps + 1, len(line)), -1)
    held = np.cumsum(edge[:-1]) > 0
    return line[held], (np.cumsum(held) - 1)[starts]


def _confirm(line, first, end, start, item, bench, found) -> None:
    words, allowed = bench.words[item], bench.allowed(item)
    n = len(words)
    if item in found and found[item][0] == 0:
        return
    low, high = max(first, start - n - allowed), min(end, start + 2 * n + allowed)
    stretch = line[low:high]
    # all but `allowed` words of the item must stand within so many words of the text
    mark = bench.mark
    mark[words] = True
    among = np.concatenate([[0], np.cumsum(mark[stretch])])
    mark[words] = False
    span = min(len(stretch), n + allowed)
    if int((among[span:] - among[: len(among) - span]).max()) < n - allowed:
        return
    distance, stop = edit_distance(words, stretch, allowed)
    if distance <= allowed and (item not in found or distance < found[item][0]):
        found[item] = (distance, int(max(0, low - first + stop - n)))


def _groups(texts: list[bytes | None]):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < CHUNK):
            size += len(texts[end] or b"")
            end += 1
        yield at, texts[at:end]
        at = end


def _parts(benchmark: DataFrame, edits: float):
    """The benchmark in parts that are small enough to broadcast, prepared."""
    some = benchmark.filter("text is not null").select("item_id", "text")
    n = max(1, -(-some.count() // ITEMS))
    for i in range(n):
        part = some.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        yield prepare(sorted(((r[0], r[1].encode()) for r in part), key=lambda x: (x[1], str(x[0]))), edits)


def contamination(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """A row for each document and benchmark item that it holds: doc_id, item_id, distance (word
    edits), item_words, and start (a word of the document near which the passage begins).

    A document holds an item if some stretch of it is within `edits` times the item's words, rounded
    down: items of few words must stand there word by word. Items without words are in no document.
    Null and empty texts hold nothing; null ids stay null; repeated documents or items
    give repeated rows. Other columns are ignored.
    """
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, distance long, item_words long, start long"
    out = docs.sparkSession.createDataFrame([], schema)
    for bench in _parts(benchmark, edits):
        shared = docs.sparkSession.sparkContext.broadcast(bench)

        def search(batches, shared=shared):
            bench = shared.value
            codes = Codes(bench.vocabulary)
            for batch in few_rows(batches, ROWS):
                rows, found = [], []
                for at, texts in _groups(as_bytes(batch["text"])):
                    for i, items in enumerate(find(texts, bench, codes), at):
                        for item, (distance, start) in sorted(items.items()):
                            rows.append(i)
                            found.append((bench.ids[item], distance, len(bench.words[item]), start))
                columns = list(zip(*found)) if found else [[]] * 4
                kinds = [None, pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(rows, pa.int64())), *(pa.array(c, k) if k or found else pa.array([], pa.int64()) for c, k in zip(columns, kinds))],
                    ["doc_id", "item_id", "distance", "item_words", "start"],
                )

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(released(search), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """docs without those that hold an item of the benchmark; see contamination."""
    for bench in _parts(benchmark, edits):
        shared = docs.sparkSession.sparkContext.broadcast(bench)

        def keep(batches, shared=shared):
            codes = Codes(shared.value.vocabulary)
            for batch in few_rows(batches, ROWS):
                at = batch.schema.get_field_index("text")
                kept = []
                for _, texts in _groups(as_bytes(batch.column(at))):
                    kept += [not items for items in find(texts, shared.value, codes)]
                yield batch.filter(pa.array(kept, pa.bool_()))

        docs = docs.mapInArrow(released(keep), docs.schema)
    return docs
