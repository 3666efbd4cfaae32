"""Language identification by a string kernel of shared character n-grams.

The kernel counts the distinct n-grams (one to three characters) that two texts share, over the
root of the product of their own counts. Nyström landmarks stand for the training texts, and
kernel ridge regression fits one machine per language against the rest. Texts are scored in
batches: presence matrix by landmark matrix by coefficients.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import stored

#: The classifier is fitted on at most so many texts of each language, of which so many in all
#: are landmarks.
PER_LANGUAGE, LANDMARKS = 1000, 160
#: Parts of the range of hashes in which they are counted.
BINS = 1 << 12
#: N-grams fall into this many hashed features.
FEATURES, ORDERS = 1 << 13, (1, 2, 3)
RIDGE, SHARPNESS = 1e-4, 6.0
ROWS, CHUNK = 256, 1 << 20
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether any character is of a letter category; numerals like ½ are none."""
    return bool(text) and any(m.group().isalpha() for m in _LETTER.finditer(text))


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: 1 for every n-gram feature that occurs in it."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    joined = "".join(t.lower().replace("\x00", " ") + "\x00" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = points == 0
    row = np.cumsum(end) - end
    flat = out.reshape(-1)
    code = np.zeros(len(points), np.uint64)
    for n in ORDERS:
        code = code[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :]
        mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        feature = (mixed >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)
        last = row[n - 1 :]
        ok = (row[: len(last)] == last) & ~end[n - 1 :]
        flat[last[ok] * FEATURES + feature[ok]] = 1
    return out


def _groups(texts: list[str]):
    """Slices of a few texts each, so that their matrices stay small."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and end - at < ROWS and (end == at or size < CHUNK):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray
    coefficients: np.ndarray

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Texts by landmarks."""
        parts = []
        for some in _groups(texts):
            x = presence(some)
            own = np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
            parts.append((x @ self.landmarks.T) / own)
        return np.concatenate(parts) if parts else np.zeros((0, len(self.landmarks)), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        language, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known and self.languages:
            margin = self.kernel([texts[i] for i in known]) @ self.coefficients
            best = margin.argmax(axis=1)
            odds = np.exp(SHARPNESS * (margin - margin.max(axis=1, keepdims=True)))
            share = 1 / odds.sum(axis=1)
            for i, b, s in zip(known, best, share):
                language[i], score[i] = self.languages[b], s
        return language, score


def nearly_least(hashes: DataFrame) -> DataFrame:
    """Of each language (lang) its PER_LANGUAGE smallest distinct hashes (h) and few others.

    Counts by the hashes' leading bits tell up to where they are needed, so what ranks a language
    gets little more than it keeps, however many texts there are.
    """
    leading = F.shiftright("h", 64 - BINS.bit_length() + 1)
    counts = hashes.groupBy("lang", leading.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = needed.filter(F.col("before") < PER_LANGUAGE).groupBy("lang").agg(F.max("bin").alias("last"))
    return hashes.join(F.broadcast(last), "lang").filter(leading <= F.col("last")).select("lang", "h")


def least_hashes(hashes: DataFrame) -> DataFrame:
    """lang, h and at: the PER_LANGUAGE smallest of each language's hashes, ranked from 1."""
    order = Window.partitionBy("lang").orderBy("h")
    ranked = nearly_least(hashes).withColumn("at", F.row_number().over(order))
    return ranked.filter(F.col("at") <= PER_LANGUAGE)


def train(labelled: DataFrame) -> Model:
    """Fit on texts with a language (doc_id, text, lang); rows with nulls or without letters are
    left out. Without any row the model knows no language.

    Of a language's texts those with the smallest hashes are taken, so the fit is on at most
    PER_LANGUAGE texts for each language; copies of a text count once.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select("lang", "text", F.xxhash64("text").alias("h"))
    spark = labelled.sparkSession
    chosen = F.broadcast(least_hashes(stored(spark, usable.select("lang", "h").distinct(), "hashes")))
    sample = usable.join(chosen, ["lang", "h"]).select("lang", "text", "at")
    sample = stored(spark, sample.dropDuplicates(["lang", "at"]), "sample")
    languages = sorted({r[0] for r in sample.select("lang").distinct().collect()})
    if not languages:
        return Model([], np.zeros((0, FEATURES), np.float32), np.zeros((0, 0)))
    each = max(1, LANDMARKS // len(languages))
    marks = [r[0] for r in sample.filter(F.col("at") <= each).orderBy("lang", "at").select("text").collect()]
    rows = np.concatenate([presence(g) for g in _groups(marks)])
    rows /= np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
    model = Model(languages, rows, np.zeros((len(rows), len(languages))))
    shared = spark.sparkContext.broadcast(model)

    def compare(batches):
        for batch in batches:
            k = shared.value.kernel(batch["text"].to_pylist()).astype(float)
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(list(k), pa.list_(pa.float64()))], ["lang", "k"])

    found = sample.select("lang", "text").mapInArrow(compare, "lang string, k array<double>").collect()
    found.sort(key=lambda r: (r[0], r[1]))
    k = np.array([r[1] for r in found])
    y = np.array([[1.0 if r[0] == x else -1.0 for x in languages] for r in found])
    count = {x: sum(r[0] == x for r in found) for x in languages}
    weight = np.array([len(found) / len(languages) / count[r[0]] for r in found])[:, None]
    marks_kernel = (rows @ rows.T).astype(float)
    left = k.T @ (weight * k) + RIDGE * len(found) * (marks_kernel + 1e-6 * np.eye(len(rows)))
    model.coefficients = np.linalg.solve(left, k.T @ (weight * y))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, other columns but text, lang_pred and score for every whole text.

    A text that is null or has no letter is `und` with score 0. Only text is read; given columns
    called lang_pred or score are left out. Null ids and repeated rows are rows like others, equal
    texts have equal results, an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]

    def add(batches):
        for batch in batches:
            language, score = shared.value.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in rest), pa.array(language, pa.string()), pa.array(score, pa.float64())],
                [*rest, "lang_pred", "score"],
            )

    schema = docs.select(*rest, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.mapInArrow(add, schema)
