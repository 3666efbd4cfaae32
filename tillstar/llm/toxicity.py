"""Toxicity by a support vector machine on gapped subsequences of characters.

The kernel compares two words by the subsequences of three characters that they share, each
weighted down by the stretch it spans, so that inserted or changed characters cost little. The
machine works on Nyström features of landmark words. As the kernel is an inner product over
subsequences, the fitted machine folds into one weight per subsequence, which gives the same
values without comparing a word with every landmark. A text counts by its most toxic word.

Labels are of whole texts, so the words to blame are found in rounds: first words that stand
in toxic texts far more often than chance allows, then each toxic text's strongest word too;
words of clean texts that score high are added to the negatives.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import released, stored

#: The classifier is fitted on at most so many labelled texts, on so many words of each kind.
TEXTS, WORDS = 12_000, 4_000
LANDMARKS, ROUNDS = 512, 3
#: Decay per character spanned and the longest span of a subsequence.
DECAY, SPAN = 0.7, 6
SYMBOLS = 32
#: Words whose value a worker remembers; characters that are looked at together; rows of a slice,
#: and of one whose words are all listed.
CACHED = 100_000
CHUNK, STRETCH = 1 << 19, 1 << 16
ROWS, AT_ONCE = 512, 64

_START, _END = 31, 30
# Characters written for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S(?!\S)){2,}")
#: What marks the ends of words in `subsequences` is no part of a word.
_UNMARKED = {1: "\x03", 2: "\x03"}
_OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def _symbols() -> np.ndarray:
    """A symbol per character up to U+FFFF; 0 for what only takes up room."""
    table = np.zeros(1 << 16, np.int64)
    for c in range(ord("a"), ord("z") + 1):
        table[c] = c - ord("a") + 1
    for c in range(0xAA, 1 << 16):
        if chr(c).isalpha():
            table[c] = 27 + c % 3
    for c, letter in LOOKALIKES.items():
        table[ord(c)] = table[ord(letter)]
    return table


_TABLE = _symbols()


def instances(text: str | None) -> set[str]:
    """The words of a text, lower-cased, and runs of single characters put together."""
    if not text:
        return set()
    low = text.lower().translate(_UNMARKED)
    return {*low.split(), *("".join(m.split()) for m in _SPACED.findall(low))}


def _symbols_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words with marks at their ends, and which word each belongs to."""
    joined = "".join(f"\x01{w}\x02" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = _TABLE[np.minimum(points, 0xFFFF)]
    symbol[points == 1], symbol[points == 2] = _START, _END
    return symbol, np.cumsum(points == 1) - 1


def _triples(symbol: np.ndarray, owner: np.ndarray, first: int, end: int):
    """Per pair of gaps the words, codes and weight of the subsequences that begin in first..end."""
    for i, j in _OFFSETS:
        m = max(first, min(end, len(symbol) - j))
        a, b, c = symbol[first:m], symbol[first + i : m + i], symbol[first + j : m + j]
        ok = np.flatnonzero((owner[first:m] == owner[first + j : m + j]) & (a > 0) & (b > 0) & (c > 0))
        yield owner[first:m][ok], (a[ok] * SYMBOLS + b[ok]) * SYMBOLS + c[ok], DECAY ** (j + 1)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of every gapped subsequence; weights of a word have norm 1
    as if all its subsequences differed."""
    symbol, owner = _symbols_of(words)
    out = [(own, code, np.full(len(own), w)) for own, code, w in _triples(symbol, owner, 0, len(symbol))]
    word, code, weight = (np.concatenate(x) for x in zip(*out))
    norm = np.sqrt(np.bincount(word, weight * weight, len(words)))
    return word, code, weight / np.maximum(norm, 1e-12)[word]


def _long_word(word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """subsequences([word]) with equal ones put together, a stretch of characters at a time."""
    symbol, owner = _symbols_of([word])
    total, norm = np.zeros(SYMBOLS**3), 0.0
    for at in range(0, len(symbol), STRETCH):
        for _, code, weight in _triples(symbol, owner, at, at + STRETCH):
            total += np.bincount(code, minlength=SYMBOLS**3) * weight
            norm += len(code) * weight**2
    code = np.flatnonzero(total)
    return np.zeros(len(code), np.int64), code, total[code] / max(math.sqrt(norm), 1e-12)


def _few_at_once(words: list[str]):
    """The place of the first, how many, and the subsequences of words that together have about
    STRETCH characters at most: all words' at once are too much for a driver."""
    at = 0
    while at < len(words):
        end, size = at + 1, len(words[at])
        while end < len(words) and size + len(words[end]) <= STRETCH:
            size += len(words[end])
            end += 1
        yield at, end - at, (_long_word(words[at]) if size > STRETCH else subsequences(words[at:end]))
        at = end


@dataclass
class Model:
    """value(word) = weights . subsequences(word) + bias; score(text) = logistic(scale * best + shift)."""

    weights: np.ndarray
    bias: float
    scale: float = 4.0
    shift: float = 0.0

    def values(self, words: list[str]) -> np.ndarray:
        """The value of each word, worked out a stretch of characters at a time, so that neither
        many words nor a very long one take much memory."""
        if not words:
            return np.zeros(0)
        symbol, owner = _symbols_of(words)
        found, norm = np.zeros(len(words)), np.zeros(len(words))
        for at in range(0, len(symbol), STRETCH):
            for own, code, weight in _triples(symbol, owner, at, at + STRETCH):
                if len(own):
                    low = own[0]  # owners rise
                    part = slice(low, own[-1] + 1)
                    found[part] += np.bincount(own - low, self.weights[code]) * weight
                    norm[part] += np.bincount(own - low) * weight**2
        return found / np.sqrt(np.maximum(norm, 1e-24)) + self.bias

    def score(self, best: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * best + self.shift, -30, 30)))


def fit_words(positive: list[str], negative: list[str], landmarks: int = LANDMARKS) -> Model:
    """A squared-hinge support vector machine on Nyström features of landmark words."""
    every = positive + negative
    order = np.random.default_rng(3).permutation
    half = landmarks // 2
    chosen = np.concatenate(
        [order(len(positive))[:half], len(positive) + order(len(negative))[:half]]
    )
    marks = np.zeros((len(chosen), SYMBOLS**3), np.float32)
    for at, _, (word, code, weight) in _few_at_once([every[i] for i in chosen]):
        np.add.at(marks, (at + word, code), weight)
    # kernel of every word with every landmark, a landmark at a time
    z = np.ones((len(every), len(chosen) + 1))
    for at, n, (word, code, weight) in _few_at_once(every):
        for i, m in enumerate(marks):
            z[at : at + n, i] = np.bincount(word, m[code] * weight, n)
    values, vectors = np.linalg.eigh(z[chosen, :-1] + 1e-6 * np.eye(len(chosen)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    for at in range(0, len(z), AT_ONCE):
        z[at : at + AT_ONCE, :-1] = z[at : at + AT_ONCE, :-1] @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    cost = np.where(y > 0, len(every) / max(1, 2 * len(positive)), len(every) / max(1, 2 * len(negative)))
    ridge = np.eye(z.shape[1]) * 1e-2 * len(every) / 100
    ridge[-1, -1] = 1e-9
    w = np.zeros(z.shape[1])
    for _ in range(30):  # Newton steps on the words inside the margin
        inside = y * (z @ w) < 1
        gram, right = ridge.copy(), np.zeros(len(w))
        for at in range(0, len(z), ROWS):
            rows = at + np.flatnonzero(inside[at : at + ROWS])
            weighted = z[rows] * cost[rows][:, None]
            gram += weighted.T @ z[rows]
            right += weighted.T @ y[rows]
        new = np.linalg.solve(gram, right)
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    found = root @ w[:-1]
    parts = [m.T.astype(float) @ found for m in np.array_split(marks, SYMBOLS, axis=1)]
    return Model(np.concatenate(parts), float(w[-1]))


def _best(model: Model, texts: list[str | None], cache: dict[str, float]) -> list[float]:
    """Each text's highest value; -1 without words."""
    out, at = [], 0
    while at < len(texts):
        group, size = [], 0
        while at < len(texts) and (not group or size < CHUNK):
            group.append(instances(texts[at]))
            size += len(texts[at] or "")
            at += 1
        new = [w for w in set().union(*group) if w not in cache]
        if len(cache) + len(new) > CACHED:
            cache.clear()
            new = list(set().union(*group))
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            cache.update(zip(part, model.values(part).tolist()))
        out += [max(map(cache.__getitem__, g), default=-1.0) for g in group]
    return out


_caches: dict[str, dict[str, float]] = {}


def _cache(key: str) -> dict[str, float]:
    if key not in _caches:
        _caches.clear()
        _caches[key] = {}
    return _caches[key]


def _calibrate(best: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic scale and shift by Newton steps, held a little towards no slope."""
    x = np.column_stack([best, np.ones_like(best)])
    # soft targets keep the slope finite where the classes separate
    y = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    w = np.array([1.0, 0.0])
    ridge = np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def in_context(batches):
    """Every word of each text with each word before it ('' for none) and the text's label, for few
    texts at once: all words of a batch would take a worker hundreds of MB, which it keeps."""
    for batch in (b.slice(at, AT_ONCE) for b in batches for at in range(0, len(b), AT_ONCE)):
        labels, found, before = [], [], []
        for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            row = text.lower().translate(_UNMARKED).split()
            new = {*zip(row, ["", *row]), *((w, "") for w in instances(text).difference(row))}
            found += [w for w, _ in new]
            before += [b for _, b in new]
            labels += [label] * len(new)
        columns = [pa.array(found, pa.string()), pa.array(before, pa.string()), pa.array(labels, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["word", "before", "toxic"])


def train(labelled: DataFrame) -> Model | None:
    """Fit on labelled texts (doc_id, text, toxic 0 or 1); None without both labels.

    Nulls are left out. Of more than TEXTS texts those with the smallest hashes are taken.
    """
    spark = labelled.sparkSession
    sample = (
        labelled.filter("toxic in (0, 1) and text is not null")
        .select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", "text").alias("h"))
        .orderBy("h", "text").limit(TEXTS).select("text", "toxic")
    )
    sample = stored(spark, sample.repartition(spark.sparkContext.defaultParallelism), "sample")
    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if not (totals.get(0) and totals.get(1)):
        return None

    # copies of a text repeat a word after the same word: so a word's support is counted in
    # different words before it, which copies don't raise
    counts = (
        sample.mapInArrow(released(in_context), "word string, before string, toxic int")
        .groupBy("word", "before")
        .agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("c"))
        .groupBy("word")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )
    counts = stored(spark, counts, "words")
    rate = totals[1] / (totals[0] + totals[1])
    # how much likelier t toxic and c clean contexts are at their own rate than at the whole's
    own = "(t + 0.01) / (t + c + 0.02)"
    gain = F.expr(f"t * ln({own} / {rate}) + c * ln((1 - {own}) / {1 - rate})")
    tried = counts.filter("t + c >= 3").count()
    strong = counts.filter(f"t >= 2 and t > c and t > {rate} * (t + c)").withColumn("gain", gain)
    strong = strong.filter(F.col("gain") >= math.log(max(2, tried)))
    blamed = {r["word"]: r["t"] for r in strong.orderBy(F.desc("gain"), "word").limit(WORDS).collect()}
    seen = counts.filter("c > 0").select("word", "c")
    plain = [r[0] for r in seen.orderBy(F.xxhash64("word"), "word").limit(WORDS // 2).collect()]
    plain += [r[0] for r in seen.orderBy(F.desc("c"), "word").limit(WORDS // 2).collect()]
    plain = [w for w in dict.fromkeys(plain) if w not in blamed]
    if not blamed or not plain:
        return None
    for _ in range(ROUNDS):
        positive = [w for w, n in blamed.items() for _ in range(1 + int(math.log2(n)))][:WORDS]
        model = fit_words(positive, plain)
        known = set(plain)
        for word, n in _witnesses(sample, model).items():
            if word not in known:
                blamed.setdefault(word, n)
        worst = {w: n for w, n in _worst(sample, model).items() if w not in blamed}
        repeated = [w for w, n in worst.items() for _ in range(1 + int(math.log2(n)))]
        plain = [*(w for w in plain if w not in worst), *repeated][-2 * WORDS :]
    shared = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def measure(batches):
        for batch in batches:
            best = _best(shared.value, batch["text"].to_pylist(), _cache(key))
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.float64()), batch["toxic"]], ["best", "toxic"])

    pairs = np.array(sample.mapInArrow(released(measure), "best double, toxic int").collect(), float)
    model.scale, model.shift = _calibrate(pairs[:, 0], pairs[:, 1] > 0)
    return model


def _witnesses(sample: DataFrame, model: Model) -> dict[str, int]:
    """The strongest word of each toxic text that the model calls toxic, with its texts."""
    rows = _strongest(sample.filter("toxic = 1"), model).filter("value > 0").groupBy("word").count()
    return {r[0]: r[1] for r in rows.orderBy(F.desc("count"), "word").limit(WORDS).collect()}


def _worst(sample: DataFrame, model: Model) -> dict[str, int]:
    """Words of clean texts that the model nearly takes for toxic, with their texts: the
    negatives it still needs."""
    rows = _strongest(sample.filter("toxic = 0"), model).filter("value > -0.5").groupBy("word")
    found = rows.agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))
    found = found.orderBy(F.desc("value"), "word").limit(WORDS // 2)
    return {r["word"]: r["n"] for r in found.collect()}


def _strongest(texts: DataFrame, model: Model) -> DataFrame:
    """Each text's word with the highest value."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def pick(batches):
        for batch in batches:
            cache, chosen, value = _cache(key), [], []
            for text in batch["text"].to_pylist():
                _best(shared.value, [text], cache)
                chosen.append(max(sorted(instances(text)), key=cache.__getitem__, default=None))
                value.append(cache.get(chosen[-1]))
            columns = [pa.array(chosen, pa.string()), pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "value"])

    return texts.select("text").mapInArrow(released(pick), "word string, value double")


def score(docs: DataFrame, model: Model | None, column: str = "toxicity") -> DataFrame:
    """docs with the score of every whole text, 0 to 1. Only the column `text` is read.

    A null or empty text scores as one whose words are all harmless. Without a model (no
    labelled texts of both kinds) all scores are 0. Null ids and repeated rows are rows like others,
    equal texts have equal scores, an empty table gives an empty one. A column that is called as the
    score is to be called is replaced.
    """
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def add(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for first in range(0, len(batch), ROWS):
                part = batch.slice(first, ROWS)
                best = _best(shared.value, part.column(at).to_pylist(), _cache(key))
                value = shared.value.score(np.array(best, float))
                yield part.append_column(made, pa.array(value, pa.float64()))

    made = column
    while made in docs.columns:  # a given column of that name gives way to the score
        made += "_"
    schema = docs.withColumn(made, F.lit(0.0).cast("double")).schema
    scored = docs.mapInArrow(released(add), schema)
    return scored if made == column else scored.drop(column).withColumnRenamed(made, column)
