"""Packing documents into fixed-length sequences by shortest-pack-first over a length histogram.

Documents are cut into pieces of at most one sequence. The histogram of piece lengths has at
most as many entries as a sequence has tokens, so the driver plans on it alone: lengths are
placed longest first, each on the shortest pack that has room, for as many packs at once as
share a pattern. Pieces then find their place by their rank among pieces of their length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstar.llm.common import few_rows, released, stored

#: Entries of one generation of a worker's cache of encoded chunks; longer chunks are not kept.
CACHED, LONGEST_CACHED = 200_000, 64
#: Texts that a worker holds at once, characters of those that are encoded together, and chunks
#: encoded in a row.
ROWS, GROUP, IN_A_ROW = 256, 1 << 18, 64
#: Pieces that share a rank bucket, about, and the fewest buckets.
PER_BUCKET, BUCKETS = 20_000, 64

# The characters that Unicode counts as white space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = r"!-/:-@\[-`{-~"
#: Chunks that the byte-level pre-tokenizer never merges across: a word with at most one space
#: before it, a run of white space without the last of it, or that last one. Latin letters that
#: begin a word are cut from ASCII marks after them, where that pre-tokenizer always cuts.
_CHUNK = re.compile(
    f" ?[A-Za-zÀ-ÖØ-öø-ÿ]++(?![^{_MARKS}{_SPACE}])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]"
)

_SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACE}]", c))

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of texts, by chunks that are encoded once and kept."""

    def __init__(self, file: str):
        # a task has one core: handing single texts to a pool of threads costs more than it gives
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Two generations: when the newer is full it becomes the older, and what is still used
        #: moves up from there. So frequent chunks are never encoded again.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: per id whether its token begins with a space
        self.spaced = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        mark = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(mark)]] = True

    @staticmethod
    def of(file: str) -> "Encoder":
        if file not in _encoders:
            _encoders[file] = Encoder(file)
        return _encoders[file]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < GROUP):
                size += len(texts[end] or "")
                end += 1
            yield from self._group(texts[at:end])
            at = end

    def _group(self, texts: list[str | None]) -> Iterator[bytes]:
        if len(self.cache) > CACHED:
            self.cache, self.older = {}, self.cache
        cut, misses = [], set()
        for text in texts:
            if text and any(s in text for s in self.special):
                cut.append(None)
                continue
            chunks = _CHUNK.findall(text or "")
            ids = list(map(self.cache.get, chunks))
            gaps = [i for i, known in enumerate(ids) if known is None]
            missing = [chunks[i] for i in gaps]
            misses.update(missing)
            cut.append((ids, gaps, missing))
        found = {c: self.older[c] for c in misses if c in self.older}
        found.update(self._chunks(misses.difference(found)))
        self.cache.update((c, ids) for c, ids in found.items() if len(c) <= LONGEST_CACHED)
        for text, parts in zip(texts, cut):
            if parts is None:
                yield self._ids(self.tokenizer.encode(text, add_special_tokens=False))
                continue
            ids, gaps, missing = parts
            for i, c in zip(gaps, missing):
                ids[i] = found[c]
            yield b"".join(ids)

    def _chunks(self, chunks: set[str]) -> Iterator[tuple[str, bytes]]:
        """Each chunk with its ids. Words that begin with a space are encoded in a row: no token
        reaches across such a space, and no other token begins with one."""
        words = [c for c in chunks if c[0] == " " and len(c) > 1 and c[1] not in _SPACES]
        for at in range(0, len(words), IN_A_ROW):
            some = words[at : at + IN_A_ROW]
            (row,) = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
            ids = np.asarray(row.ids, "<u4")
            first = np.flatnonzero(self.spaced[ids])
            if len(first) != len(some) or first[0] != 0:
                raise ValueError("the tokenizer merges across spaces")
            data = ids.tobytes()
            edges = (4 * np.append(first, len(ids))).tolist()
            yield from zip(some, (data[a:b] for a, b in zip(edges, edges[1:])))
        others = list(chunks.difference(words))
        found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        yield from ((c, self._ids(e)) for c, e in zip(others, found))

    @staticmethod
    def _ids(encoding) -> bytes:
        return np.asarray(encoding.ids, "<u4").tobytes()


def cut(batches, tokenizer: str, length: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """The pieces of the texts in Arrow batches."""
    end = np.asarray([end_id], "<u4").tobytes()
    encoder = Encoder.of(tokenizer)
    for batch in few_rows(batches, ROWS):
        rows, start, sizes, crc, total = [], array("q"), array("q"), array("q"), array("q")
        for i, ids in enumerate(encoder.encode(batch["text"].to_pylist())):
            ids += end
            n = len(ids) // 4
            for at in range(0, n, length):
                part = ids[4 * at : 4 * (at + length)]
                rows.append(i)
                start.append(at)
                sizes.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                total.append(n)
        numbers = [pa.array(np.frombuffer(x, np.int64)) for x in (start, sizes, crc, total)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].take(pa.array(rows, pa.int64())), *numbers],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int) -> DataFrame:
    """Every document's ids, end id included, cut into pieces of at most `length`."""
    run = released(partial(cut, tokenizer=tokenizer, length=length, end_id=end_id))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Pattern:
    """Packs with the same lengths in the same order: runs of (length, repeats)."""

    count: int
    used: int = 0
    runs: list[tuple[int, int]] = field(default_factory=list)

    def with_run(self, count: int, length: int, repeats: int) -> "Pattern":
        runs = list(self.runs)
        if runs and runs[-1][0] == length:
            repeats += runs.pop()[1]
        used = sum(a * b for a, b in runs) + length * repeats
        return Pattern(count, used, [*runs, (length, repeats)])


def plan(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Packing patterns for so many pieces of each length; the work grows with `size` alone."""
    by_used: dict[int, list[Pattern]] = {}
    order: list[int] = []  # the used lengths that occur, shortest first

    def add(p: Pattern) -> None:
        if p.used not in by_used:
            by_used[p.used] = []
            insort(order, p.used)
        by_used[p.used].append(p)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not order or order[0] + length > size:
                add(Pattern(left).with_run(left, length, 1))
                break
            shortest = order[0]
            pack = by_used[shortest].pop()
            if not by_used[shortest]:
                del by_used[order.pop(0)]
            n = min(left, pack.count)
            add(pack.with_run(n, length, 1))
            if pack.count > n:
                add(Pattern(pack.count - n, pack.used, pack.runs))
            left -= n
    return [p for used in order for p in by_used[used]]


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length, runs of slots as rows (first rank, repeats, first sequence, offset).

    A pattern has at most sqrt(2 * size) different lengths, and there are at most two patterns a
    length, so the table is bounded by the sequence length whatever the data.
    """
    taken: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    first = 0
    for p in patterns:
        offset = 0
        for length, repeats in p.runs:
            rank = taken.get(length, 0)
            out.setdefault(length, []).append((rank, repeats, first, offset))
            taken[length] = rank + repeats * p.count
            offset += length * repeats
        first += p.count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def ranked(cut: DataFrame) -> DataFrame:
    """Pieces with their rank among the pieces of their length.

    Ranks are counted in buckets of about PER_BUCKET pieces, so a length that most pieces have
    is spread; each bucket's ranks start where the buckets before it end.
    """
    total = cut.count()
    n = max(BUCKETS, -(-total // PER_BUCKET))
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(n)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    order = keyed.withColumn("inside", F.row_number().over(inside) - 1)
    return order.join(offsets, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("inside")
    ).drop("bucket", "before", "inside")


def pack(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    docs: doc_id and text; other columns are ignored. A null or empty text is the end id alone.
    Repeated rows are documents of their own; a null doc_id stays null. Pieces are cut at
    multiples of `length`, so all but a document's last fill a sequence.
    """
    spark: SparkSession = docs.sparkSession
    cut = stored(spark, pieces(docs, tokenizer, length, end_id), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    places = spark.sparkContext.broadcast(slots(plan(histogram, length)))

    def place(batches):
        for batch in batches:
            lengths, ranks = (batch[c].to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty_like(lengths), np.empty_like(lengths)
            for size in np.unique(lengths):
                rows = lengths == size
                runs = places.value[int(size)]
                run = runs[np.searchsorted(runs[:, 0], ranks[rows], side="right") - 1]
                at = ranks[rows] - run[:, 0]
                sequence[rows] = run[:, 2] + at // run[:, 1]
                offset[rows] = run[:, 3] + at % run[:, 1] * size
            kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )
