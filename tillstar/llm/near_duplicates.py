"""Near-duplicate documents by a chosen-path join on minwise tokens.

A document is the set of its word shingles. Independent trees branch the documents: each level
deals a node's documents out by one more minwise token, so similar documents tend to stay
together and others part soon. Small nodes are compared exhaustively. In a large one every
document is compared with the node's first; documents that this links need no more comparison
with each other, so a node goes on branching only for the rest, and what is still large at the
last level is compared with the rest in blocks. There a parity sketch of the sets, whose bits
differ in no more places than the sets do, and estimates from the signature drop hopeless pairs
before they are made; every link is confirmed on the full sets. Equal sets are one class from the
start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import as_bytes, few_rows, lookup, mix64, released, stored, words

#: Independent trees and levels: a pair at similarity 0.8 parts in all trees' first level with a
#: probability of 0.2 ** 8. One minwise token for each level of each tree.
TREES, LEVELS = 8, 6
TOKENS = TREES * LEVELS
#: Bits of a parity sketch: of sets up to about twice as many shingles it tells the difference.
SKETCH = 1024
#: Texts or sets that a worker holds at once.
ROWS = 1024
#: Nodes up to this size are compared exhaustively; documents of a block of a larger one.
SMALL, PAIRS = 48, 1000
CACHED = 300_000

_word_ids: dict[bytes, int] = {}


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The sorted distinct 64-bit shingles of a text; with fewer words, all of them as one."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    ids = _word_ids
    try:
        w = np.array([ids[x] for x in found], np.uint64)
    except KeyError:
        if len(ids) > CACHED:
            ids.clear()
        for x in set(found):
            if x not in ids:
                ids[x] = xxhash.xxh3_64_intdigest(x)
        w = np.array([ids[x] for x in found], np.uint64)
    n = max(1, len(w) - width + 1)
    out = np.full(n, min(len(w), width), np.uint64)
    for i in range(min(len(w), width)):
        out = mix64(out * np.uint64(0x100000001B3) + w[i : i + n])
    return np.unique(out)


_rng = np.random.default_rng(17)
_FACTORS = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64)


def minwise(values: np.ndarray) -> np.ndarray:
    """A minwise token per hash function, as signed 32-bit numbers."""
    out = np.empty(TOKENS, np.uint64)
    for i in range(TOKENS):
        out[i] = ((values + _SHIFTS[i]) * _FACTORS[i]).min()
    return (mix64(out) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def parity_sketch(values: np.ndarray) -> np.ndarray:
    """Per hash value of a set's shingles whether an odd number has it, as signed 64-bit words."""
    odd = np.bincount((mix64(values) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per document: doc_id, n_shingles, set (a digest of its set; null without words), sig, sketch."""

    def sign(batches):
        for batch in few_rows(batches, ROWS):
            n, digest, sig, sketch = [], [], [], []
            for text in as_bytes(batch["text"]):
                values = shingles(text, width)
                n.append(len(values))
                digest.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                sig.append(minwise(values) if len(values) else None)
                sketch.append(parity_sketch(values) if len(values) else None)
            lists = [pa.array(sig, pa.list_(pa.int32())), pa.array(sketch, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(digest, pa.binary()), *lists],
                ["doc_id", "n_shingles", "set", "sig", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, set binary, sig array<int>, sketch array<long>"
    return docs.select("doc_id", "text").mapInArrow(released(sign), schema)


def least_matches(percent: int) -> int:
    """Equal minwise tokens that a similar pair has, but for one in a million."""
    p = percent / 100
    return int(TOKENS * p - 5 * (TOKENS * p * (1 - p)) ** 0.5)


def _matches(a: str, b: str) -> Column:
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda s, x: s + x)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sets of columns (n, sig, sketch) with these suffixes can be similar, by their sizes, by
    their sketches (both without false negatives) and by the tokens that they share."""
    fewest = " + ".join(f"bit_count(sketch_{a}[{i}] ^ sketch_{b}[{i}])" for i in range(SKETCH // 64))
    return (
        F.expr(f"least(n_{a}, n_{b}) * 100 >= greatest(n_{a}, n_{b}) * {percent}")
        & F.expr(f"({fewest}) * {100 + percent} <= (n_{a} + n_{b}) * {100 - percent}")
        & (_matches(f"sig_{a}", f"sig_{b}") >= least_matches(percent))
    )


class _Join:
    """The state of one join: classes (id, n, sig, sketch), their sets on demand, confirmed links."""

    def __init__(self, docs: DataFrame, classes: DataFrame, percent: int, width: int):
        self.docs, self.classes, self.percent, self.width = docs, classes, percent, width
        self.spark = docs.sparkSession
        self.links: list[DataFrame] = []

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b) those that are similar; stored, and kept as links."""
        sig = self.classes.select("id", "n", "sig")
        left = sig.toDF("a", "n_a", "sig_a")
        right = sig.toDF("b", "n_b", "sig_b")
        pairs = stored(self.spark, pairs.distinct(), "pairs")
        # both sides are plain tables, so adaptive execution splits a key with many pairs
        close = pairs.join(left, "a").join(right, "b").filter(
            (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)
            & (_matches("sig_a", "sig_b") >= least_matches(self.percent))
        )
        close = stored(self.spark, close.select("a", "b"), "close")
        if close.isEmpty():
            return close
        sets = self._sets(close)
        both = close.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        percent = self.percent

        def check(batches):
            for batch in few_rows(batches, ROWS):
                kept = []
                for a, b in zip(batch["set_a"].to_pylist(), batch["set_b"].to_pylist()):
                    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    kept.append(100 * common >= percent * (len(a) + len(b) - common))
                yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

        links = both.select("a", "b", "set_a", "set_b").mapInArrow(released(check), close.schema)
        self.links.append(stored(self.spark, links, "links"))
        return self.links[-1]

    def _sets(self, pairs: DataFrame) -> DataFrame:
        """The full sets of the classes in these pairs, from the texts.

        The wanted ids are a stored table, so Spark knows its size: while it is small it is
        broadcast and only texts of these ids go on; beyond that the ids and texts are shuffled.
        """
        wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        width = self.width

        def gather(batches):
            for batch in few_rows(batches, ROWS):
                sets = [shingles(t, width).tobytes() for t in as_bytes(batch["text"])]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets, pa.binary())], ["id", "set"])

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        wanted = stored(self.spark, wanted, "wanted")
        texts = self.docs.select("doc_id", "text").join(wanted, "doc_id")
        return stored(self.spark, texts.mapInArrow(released(gather), f"id {kind}, set binary"), "sets")

    def run(self) -> DataFrame:
        """All links (a, b)."""
        rows = self.classes.select(
            "id", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), F.lit(0).cast("long").alias("node"), F.lit(False).alias("covered")
        )
        for level in range(LEVELS):
            rows = self._level(rows, level)
            if rows is None:
                break
        if not self.links:
            return self.classes.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
        out = self.links[0]
        for more in self.links[1:]:
            out = out.union(more)
        return out

    def _level(self, rows: DataFrame, level: int) -> DataFrame | None:
        """Branch once; compare what can be compared; the rows that go on to the next level."""
        token = F.element_at("sig", F.col("tree") * LEVELS + level + 1)
        dealt = rows.select("id", "tree", F.xxhash64("tree", "node", token).alias("node"), "sig")
        nodes = dealt.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first"))
        nodes = stored(self.spark, nodes.filter("size > 1"), "nodes")
        held = lookup(dealt.drop("sig"), nodes, "node", "size").filter("size is not null")
        held = stored(self.spark, held, "held")
        if held.isEmpty():
            return None
        star = held.filter("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
        linked = self.confirm(star).select(F.col("a").alias("first"), F.col("b").alias("id"), F.lit(True).alias("linked"))
        held = held.join(linked.distinct(), ["first", "id"], "left").withColumn(
            "covered", F.coalesce("linked", F.col("id") == F.col("first"))
        )
        held = stored(self.spark, held.drop("linked"), "covered")
        rest = held.filter("not covered").groupBy("node").agg(F.count(F.lit(1)).alias("rest"))
        open_nodes = stored(self.spark, rest.join(nodes, "node").select("node", "rest", "size"), "open")
        going = lookup(held.drop("size"), open_nodes, "node", "size").filter("size is not null")
        going = stored(self.spark, going, "going")
        last = level == LEVELS - 1
        compared = going if last else going.filter(F.col("size") <= SMALL)
        if not compared.isEmpty():
            self.confirm(self._pairs(compared))
        if last:
            return None
        large = going.filter(F.col("size") > SMALL)
        if large.isEmpty():
            return None
        sigs = self.classes.select("id", "sig")
        return stored(self.spark, large.select("id", "tree", "node").join(sigs, "id"), "large")

    def _pairs(self, rows: DataFrame) -> DataFrame:
        """In each node every document that its first one doesn't link, with all others.

        The two sides meet in blocks, so that no task holds a whole large node.
        """
        # a plain table on both sides, so adaptive execution splits an id of many nodes
        rows = rows.join(self.classes.select("id", "n", "sig", "sketch"), "id")
        parts = F.ceil(F.col("size") / PAIRS).cast("int")
        block = F.pmod(F.xxhash64("id"), parts).cast("int")
        every = F.explode(F.sequence(F.lit(0), parts - 1))

        def side(name: str) -> list[Column]:
            return [F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "sig", "sketch"))]

        ask = rows.filter("not covered").select("node", every.alias("block"), *side("x"))
        others = rows.select("node", block.alias("block"), "covered", *side("y")).withColumnsRenamed(
            {"node": "node_y", "block": "block_y"}
        )
        same = F.expr("node = node_y and block = block_y and x != y and (covered or x < y)")
        met = ask.join(others, same & _may_link("x", "y", self.percent))
        return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest reachable id) for all ids in links (a, b).

    Each round takes the least label of the neighbours and then the label of that label, so the
    rounds grow with the logarithm of the longest chain in usual cases.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a != b").distinct()
    edges = stored(spark, both, "edges")
    labels = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("component"), F.count(F.lit(1)).alias("degree"))
    labels = stored(spark, labels.withColumnRenamed("a", "id"), "labels")
    while True:
        near = labels.select(F.col("id").alias("b"), F.col("component").alias("near"), "degree")
        seen = lookup(edges, near, "b", "degree").groupBy("a").agg(F.min("near").alias("near"))
        new = labels.join(seen.withColumnRenamed("a", "id"), "id").select(
            "id", "degree", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        new = stored(spark, new, "new")
        followers = new.groupBy("component").agg(F.count(F.lit(1)).alias("followers"))
        heads = new.select(F.col("id").alias("component"), F.col("component").alias("head"))
        jump = stored(spark, followers.join(heads, "component"), "jump")
        moved = lookup(new, jump, "component", "followers")
        labels = stored(
            spark, moved.select("id", "degree", "old", F.least("component", F.coalesce("head", "component")).alias("component")), "labels"
        )
        if labels.filter("old != component").isEmpty():
            return labels.select("id", "component")


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept.

    Documents link if 100 * intersection >= percent * union of their shingle sets. Texts without
    words have no shingles and no links; rows of one doc_id count as one document; rows with a
    null doc_id take no part, have a null component and are kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    signed = stored(spark, signatures(docs, width), "signatures")
    known = signed.filter("set is not null and doc_id is not null")
    classes = known.groupBy("set").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
        F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"),
    )
    classes = stored(spark, classes, "classes")
    found = components(_Join(docs, classes, percent, width).run())
    grouped = classes.select("set", "id", "copies").join(found, "id", "left")
    grouped = grouped.filter("copies > 1 or component is not null").select(
        "set", "copies", F.coalesce("component", "id").alias("component")
    )
    grouped = stored(spark, grouped, "grouped")
    columns = ["doc_id", "n_shingles", "set"]
    out = lookup(known.select(*columns), grouped, "set", "copies").select(*columns, "component")
    alone = signed.filter("set is null or doc_id is null").select(*columns)
    out = out.unionByName(alone.withColumn("component", F.col("doc_id")))
    own = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )
