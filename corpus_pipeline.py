"""From raw documents to packed training sequences, in five stored stages."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import decontaminate, line_dedup, near_duplicates, packing, toxicity
from tillstar.llm.common import held_out, ship, stored, table

#: Documents that score at least this are rejected.
TOXIC = 0.5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold; the classifier learns from the labelled ones among them,
    but for the held-out quarter. Null and empty texts stay."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").filter(~held_out(4)).select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text").join(labels, "doc_id"))
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return toxicity.score(docs, model, name).filter(F.col(name) < TOXIC).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one. n_chars is kept as it was."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, and all others that
    belong to no group."""
    ship(spark)
    found = near_duplicates.near_duplicates(docs)
    gone = stored(spark, found.filter("not kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: The classifier has no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of `documents`; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
