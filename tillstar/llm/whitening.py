"""Embedding whitening: a covariance over distinct vectors by multiplicity, projected once each.

Entries become whole numbers, so equal vectors can be grouped and their sums are exact. The
covariance is a weighted GEMM over the distinct vectors, centred on the exact mean, with a weight
of one or of the number of copies. Each distinct vector is whitened once and joined back to
its rows by a digest. Vectors of different lengths are different spaces, fitted apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import lookup, row_sums, stored

#: An entry c counts as floor(SCALE * c) + SHIFT; components that are returned.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Beyond this an entry has no exact whole number in a long.
LARGEST = 2.0**56
#: Entries of a slice that is centred at once.
SLICE = 1 << 20
#: A variance below this part of the largest one is rounding, not variance.
NOTHING = 1e-13


def whole_numbers(embedding: Column) -> Column:
    """The entries as longs; null if the vector, or an entry, is null, not finite or beyond LARGEST."""
    usable = F.forall(embedding, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    x = F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    return F.when(usable, x)


def digest(x: Column) -> Column:
    """16 bytes that stand for a whole-number vector."""
    return F.substring(F.unhex(F.sha2(F.array_join(x.cast("array<string>"), ","), 256)), 1, 16)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows with one length: length, the vectors as a matrix, the row numbers."""
    lists = batch["x"]
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    begin = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        step = max(1, SLICE // max(int(d), 1))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield int(d), values[begin[some][:, None] + np.arange(d)], some


@dataclass
class Space:
    """The fit of all vectors of one length."""

    n: int  # weight of the fit list
    sums: list[int]
    components: np.ndarray | None = None  # unit vectors as columns, by falling variance
    variances: np.ndarray | None = None
    explained: np.ndarray | None = None

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: as longs where they fit, else as Python's whole numbers."""
        means = [s // self.n for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, means)]
        far = int(np.abs(x).max(initial=0)) + max(map(abs, means), default=0)
        if far * self.n + self.n < 2**62:
            return (x - np.array(means, np.int64)) * self.n - np.array(rest, np.int64)
        return (x.astype(object) - np.array(means, object)) * self.n - np.array(rest, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n

    def squares(self, x: np.ndarray) -> list[int]:
        """Per row the exact sum of (n * x - S)^2."""
        y = self.deviations(x)
        if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * max(y.shape[1], 1) >= 2**62:
            y = y.astype(object)
        return [int(s) for s in (y * y).sum(axis=1)]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """One column per component; NaN where a component has no variance."""
        e = self.variances
        scale = np.where(e > NOTHING * max(e.max(initial=0), 0), e, np.nan)
        return self.centred(x) @ self.components / np.sqrt(scale)


def _weights(batch: pa.RecordBatch, by_copies: bool) -> np.ndarray:
    copies = batch["copies"].to_numpy(zero_copy_only=False)
    return copies if by_copies else np.ones_like(copies)


def _sums(distinct: DataFrame, by_copies: bool) -> dict[int, Space]:
    """Per length the weight and the exact sums of the fit list."""

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            w = _weights(batch, by_copies)
            for d, x, rows in _slices(batch):
                # the weight itself is one more dimension, so a length of 0 has one too
                large = int(np.abs(x).max(initial=1)) * int(w[rows].sum()) >= 2**62
                y, v = (x.astype(object), w[rows].astype(object)) if large else (x, w[rows])
                part = np.append((y * v[:, None]).sum(axis=0), v.sum()).astype(object)
                totals[d] = totals[d] + part if d in totals else part
        rows = [(d, i, str(int(s))) for d, t in totals.items() for i, s in enumerate(t)]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["d", "i", "s"])

    parts = distinct.mapInArrow(add, "d int, i int, s string")
    found = parts.groupBy("d", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("d", "i").collect()
    sums: dict[int, list[int]] = {}
    for d, _, s in found:
        sums.setdefault(d, []).append(int(s))
    return {d: Space(s[-1], s[:-1]) for d, s in sums.items()}


def _matrices(distinct: DataFrame, spaces: dict[int, Space], centred, by_copies: bool) -> dict[int, np.ndarray]:
    """Per length the weighted sum of y'y over the fit list, y = centred(space, batch)."""
    shared = distinct.sparkSession.sparkContext.broadcast(spaces)
    base = dict(zip(spaces, np.cumsum([0, *(max(d, 1) for d in spaces)])))

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            w = _weights(batch, by_copies)
            for d, y, rows in centred(shared.value, batch):
                part = (y * w[rows][:, None]).T @ y
                totals[d] = totals[d] + part if d in totals else part
        for d, t in totals.items():
            slots = np.arange(len(t), dtype=np.int32) + base[d]
            lists = pa.array(t.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), lists], ["slot", "v"])

    sums = row_sums(distinct.mapInArrow(add, "slot int, v array<double>"))
    return {
        d: np.array([sums[i] for i in range(base[d], base[d] + d) if i in sums]) for d in spaces if base[d] in sums
    }


def _centred_vectors(spaces: dict[int, Space], batch: pa.RecordBatch):
    for d, x, rows in _slices(batch):
        yield d, spaces[d].centred(x), rows


def fit(distinct: DataFrame, by_copies: bool = False) -> dict[int, Space]:
    """A space per vector length from (x array<long>, copies long) with distinct x.

    The driver holds a d by d matrix per length, never vectors.
    """
    spaces = _sums(distinct, by_copies)
    for d, products in _matrices(distinct, spaces, _centred_vectors, by_copies).items():
        space = spaces[d]
        variances, vectors = np.linalg.eigh(products / space.n)
        falling = np.argsort(-variances, kind="stable")[:COMPONENTS]
        space.variances, space.components = np.maximum(variances[falling], 0), vectors[:, falling]
        trace = np.trace(products) / space.n
        space.explained = space.variances / trace if trace > 0 else np.full(len(falling), np.nan)
    return spaces


def _project(distinct: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(spaces)

    def project(batches):
        for batch in batches:
            whitened, squares, sizes = [None] * len(batch), [None] * len(batch), [0] * len(batch)
            for d, x, rows in _slices(batch):
                space = shared.value[d]
                w = space.whiten(x) if d else np.zeros((len(rows), 0))
                for r, v, s in zip(rows, w, space.squares(x)):
                    whitened[r], squares[r], sizes[r] = [None if np.isnan(c) else c for c in v], str(s), d
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["copies"], pa.array(sizes, pa.int32()), pa.array(squares, pa.string()),
                 pa.array(whitened, pa.list_(pa.float64()))],
                ["key", "copies", "d", "deviation", "whitened"],
            )

    schema = "key binary, copies long, d int, deviation string, whitened array<double>"
    return distinct.mapInArrow(project, schema).withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def _errors(projected: DataFrame, spaces: dict[int, Space], by_copies: bool) -> dict[int, float]:
    """Per length the largest absolute entry of the whitened covariance minus the identity,
    over the components that have a variance."""
    weight = F.col("copies") if by_copies else F.lit(1)
    one = projected.select("d", weight.cast("double").alias("w"), F.posexplode("whitened"))
    means = one.groupBy("d", "pos").agg((F.sum(F.col("w") * F.col("col")) / F.sum("w")).alias("m")).collect()
    centre = {d: np.full(COMPONENTS, np.nan) for d in spaces}
    for d, pos, m in means:
        centre[d][pos] = np.nan if m is None else m

    def centred(_, batch):
        sizes = batch["d"].to_numpy(zero_copy_only=False)
        flat = batch["whitened"].flatten().to_numpy(zero_copy_only=False).astype(float)
        per_row = np.diff(batch["whitened"].offsets.to_numpy())
        begin = np.cumsum(per_row) - per_row
        for d in np.unique(sizes):
            if d:
                rows = np.flatnonzero(sizes == d)
                k = per_row[rows[0]]
                yield int(d), flat[begin[rows][:, None] + np.arange(k)] - centre[d][:k], rows

    found = {}
    for d, products in _matrices(projected, spaces, centred, by_copies).items():
        off = np.abs(products / spaces[d].n - np.eye(len(products)))
        found[d] = float(np.nanmax(off)) if np.isfinite(off).any() else None
    return found


def whiten(vectors: DataFrame, by_copies: bool = False) -> DataFrame:
    """Every usable row (vec_id, embedding) with its whitened vector.

    Columns: vec_id; n, the weight of its fit list; deviation decimal(38,0), the exact sum of
    (n * x - S)^2, null beyond 38 digits; whitened, explained array<double>, up to COMPONENTS
    entries by falling variance; identity_error. The fit list holds each distinct x once, or with
    by_copies as often as it occurs.

    Rows whose vector is null, or holds an entry that is null, not finite or beyond LARGEST, are left
    out. Only vec_id and embedding are read, whatever other columns are called. Null and repeated
    ids are rows like others; equal vectors of different rows have equal results. Vectors of
    different lengths are fitted apart; empty ones have no component. A component without variance
    has null in `whitened`, and without any variance `explained` is null too. No rows, no result.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", whole_numbers(F.col("embedding")).alias("x")).filter("x IS NOT NULL")
    keyed = stored(spark, rows.select("vec_id", digest(F.col("x")).alias("key")), "rows")
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = stored(spark, counted.select("x", "copies", digest(F.col("x")).alias("key")), "distinct")
    spaces = fit(distinct, by_copies)
    projected = stored(spark, _project(distinct, spaces), "projected")
    errors = _errors(projected, spaces, by_copies)

    facts = [
        (d, s.n, [None if np.isnan(e) else float(e) for e in (s.explained if s.explained is not None else [])], errors.get(d))
        for d, s in spaces.items()
    ]
    per_length = spark.createDataFrame(facts, "d int, n long, explained array<double>, identity_error double")
    joined = lookup(keyed, projected, "key", "copies").join(F.broadcast(per_length), "d")
    return joined.select("vec_id", "n", "deviation", "whitened", "explained", "identity_error")
