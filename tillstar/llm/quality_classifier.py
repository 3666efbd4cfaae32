"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

A text becomes a short vector of statistics (`STATISTICS`). Cosines of random projections stand
for a Gaussian kernel over the standardised vectors. Every task adds up its part of the normal
equations, so all labelled rows are fitted, whatever their number. The equations are kept by fold:
a labelled row is calibrated on the score of the machine that was fitted without its fold. The
calibration is isotonic (pool adjacent violators) over a fixed grid of scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import as_bytes, row_sums, ship, stored

#: Cosine features, folds, ridge per labelled row, width of the kernel in standard deviations.
FEATURES, FOLDS, RIDGE, WIDTH = 192, 3, 1e-4, 3.0
#: Standardised statistics are cut off here, so that no single one rules a projection.
CUT = 5.0
#: Scores of the ridge machine are calibrated in steps of this size between these ends.
STEP, LOW, HIGH = 1 / 2048, -1.0, 2.0
#: Words in which distinct ones are counted; bytes of a text that are looked at at once.
WINDOW, PIECE = 64, 1 << 20
SEED = 11

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "letters", "capitals", "digits",
    "symbols", "spaces", "beyond_ascii", "controls", "entropy", "words_without_letters",
    "words_with_symbols", "capital_words", "single_words", "long_words", "words_as_last",
    "words_as_last_but_one", "distinct_in_window", "sentence_ends", "log_line_words",
    "lines_as_last", "short_lines",
)

_SPACE, _LOWER, _UPPER, _DIGIT, _SYMBOL, _LEAD, _CONTINUED, _CONTROL = range(8)
_CLASS = np.full(256, _CONTROL, np.uint8)
_CLASS[0x21:0x7F] = _SYMBOL
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[0x80:0xC0] = _CONTINUED
_CLASS[0xC0:] = _LEAD
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[ord("A") : ord("Z") + 1] += np.uint64(32)
_CLASSES, _WORDS, _LINES = 8, 12, 4


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of at most PIECE bytes, cut after white space where there is any."""
    at = 0
    while len(text) - at > PIECE:
        end = max(text.rfind(b" ", at, at + PIECE), text.rfind(b"\n", at, at + PIECE)) + 1
        end = end if end > at else at + PIECE
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:] if at else text


def _counts(pieces: list[bytes]) -> np.ndarray:
    """Per piece the additive counts behind the statistics: bytes by class, bytes by value,
    then words and lines."""
    n = len(pieces)
    joined = np.frombuffer(b"\n".join(pieces) + b"\n", np.uint8)
    owner = np.repeat(np.arange(n), [len(p) + 1 for p in pieces])
    kind = _CLASS[joined]
    classes = np.bincount(owner * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    values = np.bincount(owner * 256 + joined, minlength=n * 256).reshape(n, 256)
    classes[:, _SPACE] -= 1  # the line break that was added
    values[:, ord("\n")] -= 1

    inside = kind != _SPACE
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[::2], edge[1::2]  # the last byte is a line break
    words, lines = np.zeros((n, _WORDS)), np.zeros((n, _LINES))
    if len(start):
        length = end - start
        where = np.flatnonzero(inside)
        first = np.cumsum(length) - length
        place = np.arange(len(where)) - np.repeat(first, length)
        letters = _FOLD[joined[where]] + (place.astype(np.uint64) << np.uint64(8))
        code = np.add.reduceat(_scramble(letters), first)
        kinds = kind[where]

        def holds(*some: int) -> np.ndarray:
            return np.add.reduceat(np.isin(kinds, some).astype(np.int32), first)

        mine = owner[start]
        letter, upper, symbol = holds(_LOWER, _UPPER, _LEAD), holds(_UPPER), holds(_SYMBOL)
        same = [
            np.concatenate([np.zeros(min(k, len(code)), bool), (code[k:] == code[:-k]) & (mine[k:] == mine[:-k])])
            for k in (1, 2)
        ]
        # distinct words of each window of WINDOW words; a window lies in one piece
        begin = np.searchsorted(mine, np.arange(n))
        window = mine * (len(mine) // WINDOW + 1) + (np.arange(len(mine)) - begin[mine]) // WINDOW
        order = np.lexsort((code, window))
        new = np.ones(len(order), bool)
        new[1:] = (code[order][1:] != code[order][:-1]) | (window[order][1:] != window[order][:-1])
        last = joined[end - 1]
        ends = (last == ord(".")) | (last == ord("?")) | (last == ord("!"))
        for i, x in enumerate((
            np.ones(len(mine)), length, length.astype(float) ** 2, letter == 0, symbol > ends,
            (upper == letter) & (letter > 1), length == 1, length > 25, *same,
        )):
            words[:, i] = np.bincount(mine, weights=x, minlength=n)
        words[:, 10] = np.bincount(mine[order], weights=new, minlength=n)
        words[:, 11] = np.bincount(mine, weights=ends, minlength=n)

        line = np.cumsum(joined == ord("\n"))[start]
        head = np.flatnonzero(np.diff(line, prepend=-1))
        size = np.diff(head, append=len(line))
        nth = (np.arange(len(line)) - np.repeat(head, size)).astype(np.uint64)
        whole = np.add.reduceat(_scramble(code + (nth << np.uint64(1))), head)
        whose = mine[head]
        again = np.zeros(len(head), bool)
        again[1:] = (whole[1:] == whole[:-1]) & (whose[1:] == whose[:-1])
        for i, x in enumerate((np.ones(len(head)), again, size < 4)):
            lines[:, i] = np.bincount(whose, weights=x, minlength=n)
    return np.hstack([classes, values, words, lines]).astype(float)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def statistics_of(texts: list[bytes | None]) -> np.ndarray:
    """One row of STATISTICS per text; those of a null text are those of the empty one. Longer
    texts than PIECE are counted piece by piece, so memory doesn't grow with them."""
    total = np.zeros((len(texts), _CLASSES + 256 + _WORDS + _LINES))
    some: list[bytes] = []
    whose: list[int] = []

    def flush() -> None:
        np.add.at(total, whose, _counts(some))
        some.clear()
        whose.clear()

    held = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or b""):
            if some and (held + len(piece) > PIECE or len(some) >= 512):
                flush()
                held = 0
            some.append(piece)
            whose.append(i)
            held += len(piece)
    if some:
        flush()

    c, v = total[:, :_CLASSES], total[:, _CLASSES : _CLASSES + 256]
    w, lines = total[:, _CLASSES + 256 : -_LINES], total[:, -_LINES:]
    size, count = v.sum(axis=1), w[:, 0]
    letters = c[:, _LOWER] + c[:, _UPPER] + c[:, _LEAD]
    share = v / np.maximum(size, 1)[:, None]
    mean = _ratio(w[:, 1], count)
    return np.column_stack([
        np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(_ratio(w[:, 2], count) - mean**2, 0)),
        _ratio(letters, size), _ratio(c[:, _UPPER], letters), _ratio(c[:, _DIGIT], size),
        _ratio(c[:, _SYMBOL], size), _ratio(c[:, _SPACE], size), _ratio(c[:, _LEAD], size),
        _ratio(c[:, _CONTROL], size), -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1),
        *(_ratio(w[:, i], count) for i in range(3, 12)),
        np.log1p(_ratio(count, lines[:, 0])), _ratio(lines[:, 1], lines[:, 0]), _ratio(lines[:, 2], lines[:, 0]),
    ])


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) for every row, over whole texts. Only doc_id and text are read, whatever
    other columns are called; null ids and repeated rows are rows like others."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    def count(batches):
        for batch in batches:
            rows = statistics_of(as_bytes(batch["text"]))
            flat = pa.array(rows.reshape(-1))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.ListArray.from_arrays(ends, flat)], ["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(count, f"doc_id {kind}, stats array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch["stats"]
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), len(STATISTICS))


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray  # one column per fold left out, the last one fitted on all
    knots: np.ndarray  # ridge scores ...
    levels: np.ndarray  # ... and what they are worth

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -CUT, CUT)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.column_stack([z, np.ones(len(z))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        """0 to 1, higher for label 1; rounded, so that the order of sums doesn't show."""
        raw = self.features(stats) @ self.weights[:, -1]
        return np.round(np.interp(raw, self.knots, self.levels), 6)


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to total / weight over rising x, as the middle and the
    level of each step."""
    blocks: list[list[float]] = []  # sum of x by weight, sum of labels, weight
    for xi, ti, wi in zip(x, total, weight):
        blocks.append([xi * wi, ti, wi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def _solve(equations: np.ndarray) -> np.ndarray:
    """Ridge weights from a summed [z 1 y]'[z 1 y]; the constant isn't held down."""
    d = len(equations) - 1
    rows = equations[d - 1, d - 1]  # sum of weights
    held = np.eye(d)
    held[-1, -1] = 1e-9
    return np.linalg.solve(equations[:d, :d] + (RIDGE * rows + 1e-9) * held, equations[:d, d])


def train(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on all rows of `stats` that `labels` (doc_id, label 0 or 1) names.

    Labels that are null or neither 0 nor 1, and null ids, take no part. An id with several labels
    counts with each of them. With labels of one kind only, or none, every score is that label, or 0.5.
    """
    spark = stats.sparkSession
    per_id = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).cast("double").alias("w"), F.avg("label").alias("y"))
    )
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    labelled = stored(spark, stats.join(per_id, "doc_id").select(fold, "w", "y", "stats"), "labelled")

    n, at = len(STATISTICS), [F.element_at("stats", i + 1) for i in range(len(STATISTICS))]
    spread = labelled.agg(F.sum("w"), F.sum(F.col("y") * F.col("w")), *map(F.avg, at), *map(F.stddev_pop, at)).first()
    total, positive = spread[0] or 0.0, spread[1] or 0.0
    rng = np.random.default_rng(SEED)
    model = Model(
        np.array(spread[2 : 2 + n], float), np.array(spread[2 + n :], float),
        rng.standard_normal((n, FEATURES)) / (WIDTH * np.sqrt(n)) * np.sqrt(2), rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros((FEATURES + 1, FOLDS + 1)), np.zeros(1), np.array([positive / total if total else 0.5]),
    )
    if not total:
        model.centre, model.scale = np.zeros(n), np.ones(n)
    model.scale[model.scale < 1e-9] = 1.0
    if positive in (0.0, total):
        return model

    shared = spark.sparkContext.broadcast(model)
    d = FEATURES + 2

    def equations(batches):
        sums = np.zeros((FOLDS, d, d))
        for batch in batches:
            w, y, fold = (batch[c].to_numpy(zero_copy_only=False) for c in ("w", "y", "fold"))
            u = np.column_stack([shared.value.features(_matrix(batch)), y])
            for k in range(FOLDS):
                of = fold == k
                sums[k] += (u[of] * w[of, None]).T @ u[of]
        rows = sums.reshape(FOLDS * d, d)
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * d)
        lists = pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), lists], ["slot", "v"])

    sums = row_sums(labelled.mapInArrow(equations, "slot int, v array<double>"))
    folds = np.array([sums[i] for i in range(FOLDS * d)]).reshape(FOLDS, d, d)
    whole = folds.sum(axis=0)
    model.weights = np.column_stack([*(_solve(whole - f) for f in folds), _solve(whole)])

    fitted = spark.sparkContext.broadcast(model)

    def unseen(batches):
        for batch in batches:
            fold = batch["fold"].to_numpy(zero_copy_only=False)
            raw = (fitted.value.features(_matrix(batch)) @ fitted.value.weights)[np.arange(len(fold)), fold]
            step = np.round((np.clip(raw, LOW, HIGH) - LOW) / STEP).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch["w"], batch["y"]], ["step", "w", "y"])

    steps = (
        labelled.mapInArrow(unseen, "step int, w double, y double")
        .groupBy("step")
        .agg(F.sum(F.col("w") * F.col("y")).alias("t"), F.sum("w").alias("w"))
        .orderBy("step")
        .collect()
    )
    grid = np.array([(LOW + s.step * STEP, s.t, s.w) for s in steps])
    model.knots, model.levels = isotonic(*grid.T)
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of `stats`."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def add(batches):
        for batch in batches:
            scores = shared.value.score(_matrix(batch))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(add, f"doc_id {kind}, score double")
