"""Token counts by a two-tier lookup of pre-token lengths on the map side.

No piece of the vocabulary has a space after another character, and none has a line break, so
byte-pair merges never cross from a character to the space after it, nor a line break. A
text's count is therefore the sum of the counts of its pre-tokens: a run of spaces with what
follows up to the next space or line break. Frequent pre-tokens come from a compact broadcast
table; the others are encoded once per worker and kept in a bounded cache. No pre-token is
shuffled; only each task's short list of frequent ones is.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of the broadcast table, of each task's list of frequent pre-tokens, of a worker's
#: cache, and of a task's running counts before rare ones are dropped from these.
TABLE, LISTED, CACHED, COUNTED = 1 << 16, 1 << 13, 1 << 18, 1 << 18
#: Longer pre-tokens are encoded each time, so that the cache stays small.
LONGEST_CACHED = 64

_PRE_TOKEN = re.compile(r" +[^ \n]*|[^ \n]+|\n")
_lengths: dict[tuple, "_Lengths"] = {}


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, the first one with the space that the model puts before it."""
    return _PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


class Encoder:
    """Token counts of single pre-tokens."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece spans pre-tokens: this vocabulary can't be counted by them")
        self.before_line = len(self.model.encode("\n"))

    def count(self, pre_token: str) -> int:
        if pre_token == " ":
            return self.before_line - len(self.model.encode("\n\n")) + self.before_line
        if pre_token[0] == " ":  # the model itself puts one space before a text
            return len(self.model.encode(pre_token[1:], num_threads=1))
        return len(self.model.encode("\n" + pre_token, num_threads=1)) - self.before_line


class _Lengths(dict):
    """The frequent pre-tokens, and the worker's cache of others."""

    def __init__(self, model: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.encoder, self.frequent = Encoder(model), frequent

    def __missing__(self, pre_token: str) -> int:
        n = self.encoder.count(pre_token)
        if len(pre_token) <= LONGEST_CACHED:
            if len(self) >= len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[pre_token] = n
        return n


def _frequent_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(x for x in pre_tokens(text or "") if len(x) <= LONGEST_CACHED)
            if len(counts) > COUNTED:
                counts = Counter(dict(counts.most_common(COUNTED // 4)))
    top = heapq.nlargest(LISTED, counts.items(), key=lambda x: (x[1], x[0]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in top], pa.string()), pa.array([x[1] for x in top], pa.int64())],
        ["pre_token", "n"],
    )


def frequent_lengths(texts: DataFrame, model: str, size: int = TABLE) -> dict[str, int]:
    """At most `size` frequent pre-tokens of all texts, with their token counts."""
    top = (
        texts.mapInArrow(_frequent_in_task, "pre_token string, n long")
        .groupBy("pre_token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "pre_token")
        .limit(size)
    )
    encoder = Encoder(model)
    return {r[0]: encoder.count(r[0]) for r in top.select("pre_token").collect()}


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """Per document its whole text's bytes, tokens, and whether the tokens exceed `limit`.

    docs: doc_id and text, other columns are ignored. Null and empty texts have no tokens; a
    repeated row gives a repeated result, a null doc_id stays null.
    """
    spark: SparkSession = docs.sparkSession
    texts = docs.select("text")
    table = spark.sparkContext.broadcast(frequent_lengths(texts, model))
    key = (model, uuid.uuid4().hex)

    def count(batches):
        if key not in _lengths:
            _lengths.clear()
            _lengths[key] = _Lengths(model, table.value)
        length = _lengths[key].__getitem__
        for batch in batches:
            tokens = [sum(map(length, pre_tokens(x))) if x else 0 for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.select("doc_id", size.alias("n_bytes"), "text").mapInArrow(
        count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
