"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Unit vectors are rotated at random, so that the first d of D dimensions estimate a distance.
A query scans its nearest lists in blocks of columns; after each block a hypothesis test drops
the candidates whose partial distance shows, with high confidence, that they are farther than
the k-th best so far. Survivors get their exact cosine on the original vectors. The index holds
every vector; only the lists' centres are fitted on a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import stored

#: Vectors that the centres are fitted on, about, but PER_LIST a list where that is more; rounds
#: of fitting; cells of a product of vectors and centres that is held at once.
SAMPLE, PER_LIST, ROUNDS, CELLS = 20_000, 4, 8, 1 << 22
#: Share of the true neighbours that the probed lists must hold, the held-out queries that it is
#: measured with, about, and the fewest lists that are probed.
RECALL, ASKED, PROBES = 0.95, 256, 48
#: Columns of a block, and the test's strength: the share of survivors wrongly dropped falls
#: with its square in the exponent.
BLOCK, EPSILON = 16, 2.1
#: Vectors and queries that meet in one task's step: larger lists are split.
VECTORS, QUERIES = 1024, 512


@dataclass
class Index:
    """vectors: vec_id, v (double array), list. centres: unit vectors, rotated. probes: lists
    that a query scans, measured (see lists_to_probe) at the first search that names none."""

    vectors: DataFrame
    rotation: np.ndarray
    centres: np.ndarray
    sizes: np.ndarray
    probes: int | None = None


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def scaled(v: np.ndarray) -> np.ndarray:
    """v over a power of two a row: no square over- or underflows, no cosine changes."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, CELLS // len(centres))
    parts = [np.argmax(x[i : i + step] @ centres.T, axis=1) for i in range(0, len(x), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def fit_centres(sample: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Spherical k-means. Centres that lose all their vectors stay where they were."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        at = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, sample)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v: vectors of the most common length, finite, without nulls, not zero."""
    v = F.col(embedding).cast("array<double>")
    fit = (
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter(fit)


def _stack(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def sampled(good: DataFrame, count: int, wanted: int, salt: int) -> DataFrame:
    """About `wanted` of `count` rows, by a hash of their id: each id with its least vector.
    Chosen where the rows are, so no task sends more than its share."""
    share = F.xxhash64("vec_id", F.lit(salt)) / float(1 << 64) + 0.5 < wanted / count
    some = good.filter(share) if wanted < count else good
    return some.groupBy("vec_id").agg(F.min("v").alias("v"))


def build(vectors: DataFrame, lists: int | None = None) -> Index | None:
    """Index all usable vectors; None if there are none. Lists: the root of their number."""
    spark = vectors.sparkSession
    good = usable(vectors)
    lengths = good.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if lengths is None:
        return None
    dims, count = lengths
    good = good.filter(F.size("v") == dims)
    n = lists or max(1, round(count**0.5))
    fitted = sampled(good, count, max(SAMPLE, PER_LIST * n), 0).orderBy("vec_id").select("v").collect()
    # ids that many rows repeat can leave a sample empty
    fitted = fitted or good.select("v").limit(1).collect()
    turn = rotation(dims)
    centres = fit_centres(unit(np.array([r[0] for r in fitted])) @ turn, n)
    shared = spark.sparkContext.broadcast((turn, centres))

    def assign(batches):
        turn, centres = shared.value
        for batch in batches:
            if batch.num_rows:
                at = _nearest(unit(_stack(batch["v"], dims)) @ turn, centres)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(at.astype(np.int32))], ["vec_id", "v", "list"]
                )

    kind = good.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, v array<double>, list int"
    listed = stored(spark, good.mapInArrow(assign, schema), "lists")
    sizes = np.zeros(len(centres), np.int64)
    for at, size in listed.groupBy("list").count().collect():
        sizes[at] = size
    return Index(listed, turn, centres, sizes)


def lists_to_probe(index: Index, k: int, recall: float = RECALL, asked: int = ASKED) -> int:
    """The fewest lists, at least PROBES, that hold `recall` of the k nearest vectors of held-out
    queries: about `asked` vectors of the index, chosen by a hash of their id.

    The answer they are measured against is exact: every partition compares all its vectors with
    the queries and keeps k of each. The driver gets k rows a query.
    """
    spark, turn, centres = index.vectors.sparkSession, index.rotation, index.centres
    total = int(index.sizes.sum())
    if (index.sizes > 0).sum() <= PROBES:
        return PROBES
    rows = sampled(index.vectors, total, asked, 1).orderBy("vec_id").collect()
    if not rows:
        return len(centres)
    queries, dims = unit(np.array([r["v"] for r in rows])), len(turn)
    shared = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in rows]), queries))

    def nearest(batches):
        own, queries = shared.value
        score = np.full((len(queries), k), -np.inf)
        place = np.full((len(queries), k), -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["vec_id"].to_numpy(zero_copy_only=False)
            near = queries @ unit(_stack(batch["v"], dims)).T
            near[own[:, None] == ids] = -np.inf
            at = np.broadcast_to(batch["list"].to_numpy(), near.shape)
            near, at = np.hstack([score, near]), np.hstack([place, at])
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            score, place = (np.take_along_axis(x, best, axis=1) for x in (near, at))
        some = np.nonzero(place >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some[0].astype(np.int32)), pa.array(score[some]), pa.array(place[some].astype(np.int32))],
            ["query", "score", "list"],
        )

    found = index.vectors.select("vec_id", "v", "list").mapInArrow(nearest, "query int, score double, list int")
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "list"))
    true = found.withColumn("rank", order).filter(F.col("rank") <= k).select("query", "list").collect()
    # per true neighbour, how many lists its query has to scan to meet it
    near = np.argsort(-(queries @ turn @ centres.T), axis=1, kind="stable")
    depth = np.argsort(near, axis=1)
    needed = np.sort([depth[q, at] + 1 for q, at in true])
    return max(PROBES, int(needed[int(np.ceil(recall * len(needed))) - 1])) if len(needed) else PROBES


def scan(queries, query_ids, vectors, ids, turn, k: int):
    """For each query its k nearest in one list: rows (query id, vector id, cosine).

    Both sides are original vectors in double precision. Ties go to the smaller id.
    """
    ids, first = np.unique(ids, return_index=True)
    vectors, queries = scaled(vectors[first]), scaled(queries)
    units, asked = unit(vectors), unit(queries)
    turned, dims = units @ turn, vectors.shape[1]
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    columns = [np.ascontiguousarray(turned[:, b : b + BLOCK]) for b in range(0, dims, BLOCK)]
    out_query, out_id, out_score = [], [], []
    for query_id, query, q in zip(query_ids, queries, asked @ turn):
        own = ids != query_id
        some = np.flatnonzero(own)[: 8 * k]
        if not len(some):
            continue
        # the k-th best of a few candidates bounds the search from the start
        near = ((turned[some] - q) ** 2).sum(axis=1)
        bound = np.partition(near, k - 1)[k - 1] if len(some) > k else np.inf
        alive, partial = np.flatnonzero(own), None
        for b, block in enumerate(columns):
            part = block if partial is None and len(alive) == len(ids) else block[alive]
            step = ((part - q[b * BLOCK : (b + 1) * BLOCK]) ** 2).sum(axis=1)
            partial = step if partial is None else partial + step
            d = min(dims, (b + 1) * BLOCK)
            slack = (1 + EPSILON / d**0.5) ** 2 if d < dims else 1
            keep = partial <= bound * slack * d / dims + 1e-9
            alive, partial = alive[keep], partial[keep]
        if len(alive) > 4 * k:  # settle most by their distance; equal ones stay
            last = np.partition(partial, k - 1)[k - 1]
            alive = alive[partial <= last + 1e-9]
        score = (vectors[alive] * query).sum(axis=1) / (norms[alive] * np.sqrt((query * query).sum()))
        best = np.lexsort((ids[alive], -score))[:k]
        out_query.append(np.full(len(best), query_id))
        out_id.append(ids[alive][best])
        out_score.append(score[best])
    return out_query, out_id, out_score


def search(index: Index, queries: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
    """Per query (vec_id, v) its k nearest vectors of the index, other than its own id.

    Each query scans its `probes` nearest lists (by default as many as lists_to_probe finds that a
    recall of RECALL needs), and more while these hold fewer than 8 * k vectors; so small indexes
    are scanned whole. Result: query_id, rank from 1, vec_id, score. Rows of one id count once, by
    their best score; a query that takes no part (see usable) has no rows.
    """
    if probes is None:
        index.probes = index.probes or lists_to_probe(index, k)
        probes = index.probes
    turn, centres, sizes = index.rotation, index.centres, index.sizes
    spark, dims = queries.sparkSession, len(turn)
    shared = spark.sparkContext.broadcast((turn, centres, sizes))

    def probe(batches):
        turn, centres, sizes = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(unit(_stack(batch["v"], dims)) @ turn @ centres.T), axis=1, kind="stable")
            held = np.cumsum(sizes[near], axis=1)
            wanted = np.maximum(probes, (held < 8 * k).sum(axis=1) + 1)
            for i in range(batch.num_rows):
                lists = near[i, : wanted[i]]
                lists = lists[sizes[lists] > 0].astype(np.int32)
                row = pa.array(np.full(len(lists), i))
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(row), batch["v"].take(row), pa.array(lists)],
                    ["query_id", "q", "list"],
                )

    kind = queries.schema["vec_id"].dataType.simpleString()
    once = queries.groupBy("vec_id").agg(F.min("v").alias("v")).filter(F.size("v") == dims)
    probed = stored(
        spark, once.mapInArrow(probe, f"query_id {kind}, q array<double>, list int"), "probes"
    )
    asked = {r[0]: r[1] for r in probed.groupBy("list").count().collect()}
    # bounded by the number of lists: how many parts each list's vectors and queries get
    parts = spark.createDataFrame(
        [
            (i, int(-(-int(sizes[i]) // VECTORS)), int(-(-n // QUERIES)))
            for i, n in asked.items()
        ],
        "list int, vector_parts int, query_parts int",
    )
    tile = ["list", "vector_part", "query_part"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    of = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    vectors = index.vectors.join(F.broadcast(parts), "list").select(
        "list", of("vec_id", "vector_parts").alias("vector_part"), every("query_parts").alias("query_part"), "vec_id", "v"
    )
    questions = probed.join(F.broadcast(parts), "list").select(
        "list", every("vector_parts").alias("vector_part"), of("query_id", "query_parts").alias("query_part"), "query_id", "q"
    )

    def meet(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = scan(
            np.stack(asking["q"]), asking["query_id"].to_numpy(), np.stack(held["v"]), held["vec_id"].to_numpy(), shared.value[0], k
        )
        names = ("query_id", "vec_id", "score")
        return pd.DataFrame({n: np.concatenate(x) if x else [] for n, x in zip(names, found)})

    met = questions.groupBy(*tile).cogroup(vectors.groupBy(*tile)).applyInPandas(
        meet, f"query_id {kind}, vec_id {kind}, score double"
    )
    # an id whose rows lie in several lists is met in each
    met = met.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return met.withColumn("rank", order).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
