"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    ann,
    class_lm,
    decontaminate,
    language,
    line_dedup,
    near_duplicates,
    packing,
    prefix_trie,
    quality_classifier,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from tillstar.llm.common import held_out, stored, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th one."""
    vectors = table(spark, sf_dir, "embeddings")
    index = ann.build(vectors)
    if index is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        schema = f"query_id {kind}, rank int, vec_id {kind}, score double"
        return spark.createDataFrame([], schema)
    return ann.search(index, index.vectors.filter("vec_id % 50 = 0").select("vec_id", "v"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, removed="removed")
    return out.select(
        "doc_id",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"),
        "text",
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    manifest = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest).select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(7).alias("held_out"), "text")
    return class_lm.score(docs, class_lm.train(docs.filter("not held_out")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    """Fitted on labelled documents outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(4)).select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.train(docs.join(labels, "doc_id"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(4).alias("held_out"), "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), "score")
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates.near_duplicates(docs, percent=85, width=3)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the item."""
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(~held_out(4)))
    return language.identify(docs.select("doc_id", held_out(4).alias("held_out"), "text"), model)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a machine fitted on labels outside the held-out fifth."""
    stats = stored(spark, quality_classifier.statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").filter(~held_out(5, 0)).select("doc_id", F.col("quality").alias("label"))
    scored = quality_classifier.score(stats, quality_classifier.train(stats, labels))
    return scored.select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector and component. A deviation that fits no long is null."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.select(
        "vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c"),
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_nearest": op1_nearest,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_class_lm": op4_class_lm,
    "op5_token_counts": op5_token_counts,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_decontamination": op9_decontamination,
    "op10_language": op10_language,
    "op11_quality": op11_quality,
    "op12_whitening": op12_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}

# Each page's record by its payload alone: the archive must give back what went in.
WARC_SQL = """
SELECT page_id, CAST(octet_length(encode(p)) AS BIGINT) AS payload_bytes, sha1(p) AS payload_digest,
  CASE WHEN octet_length(encode(p)) >= 1000 AND page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(encode(p)) >= 1000 AND page_id < m THEN m END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS p, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)
"""

# crc32 bit by bit; a prefix is known by its smallest member and its depth.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (
  SELECT conv_id, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: xor(v >> 1, (v & 1) * 3988292384)))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
  SELECT c.conv_id, list({'role': role, 'text': text} ORDER BY own, place) FILTER (place IS NOT NULL) AS said
  FROM ids c LEFT JOIN (
    SELECT c.conv_id, 0 AS own, place, role, text FROM ids c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
    UNION ALL SELECT c.conv_id, 1, place, role, text FROM ids c JOIN turns t ON t.conv_id = c.conv_id AND place > h
  ) p USING (conv_id) GROUP BY 1
),
members AS (
  SELECT conv_id AS member, depth, coalesce(len(said), 0) = depth AS is_end, coalesce(octet_length(encode(said[depth].text)), 0) AS bytes,
    min(conv_id) OVER (PARTITION BY depth, said[:depth]) AS conv_id
  FROM (SELECT conv_id, coalesce(said, []) AS said, unnest(range(0, coalesce(len(said), 0) + 1)) AS depth FROM rebuilt)
),
nodes AS (
  SELECT m.conv_id, m.depth, any_value(p.conv_id) AS parent_conv_id, count(*) AS n_convs, any_value(m.bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(m.member AS VARCHAR), ',' ORDER BY m.member) FILTER (m.is_end), '')) AS ends_sha256
  FROM members m LEFT JOIN members p ON p.member = m.member AND p.depth = m.depth - 1 GROUP BY 1, 2
),
counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.parent_conv_id = n.conv_id AND k.depth = n.depth + 1) AS n_children FROM nodes n
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM counted n JOIN (
  SELECT m.conv_id, m.depth, CAST(count(*) FILTER (w.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((w.n_convs - 1) * w.bytes) AS BIGINT) AS saved_tokens
  FROM counted w JOIN members m ON m.member = w.conv_id AND m.depth <= w.depth GROUP BY 1, 2
) b USING (conv_id, depth)
"""

ORACLE: dict[str, str] = {"op3_warc": WARC_SQL, "op13_prefix_trie": TRIE_SQL}
