"""Which hashes the language classifier ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstar.llm import language


def test_few_hashes_are_ranked(spark):
    hashes = spark.range(60_000).select(
        F.when(F.col("id") % 20 == 0, "b").when(F.col("id") == 1, "c").otherwise("a").alias("lang"), F.xxhash64("id").alias("h")
    )
    want = {}
    for lang, h in sorted((r[0], r[1]) for r in hashes.collect()):
        want.setdefault(lang, []).append(h)
    found = language.least_hashes(hashes).collect()
    got = {(r["lang"], r["at"]): r["h"] for r in found}
    assert got == {(x, i): h for x, v in want.items() for i, h in enumerate(v[: language.PER_LANGUAGE], 1)}
    # fewer than before, also of a language that most rows have, go to the task that ranks it
    assert len(want["a"]) > 50_000 and language.nearly_least(hashes).filter("lang = 'a'").count() < 1.1 * language.PER_LANGUAGE
