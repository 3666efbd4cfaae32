"""Line-level deduplication by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words; equal lines are one class. For a Jaccard similarity of
t two sets of sizes n and m must share ceil(t / (1 + t) * (n + m)) words, so both have a shared
word among their first n - ceil(t * n) + 1 words in any fixed order: words are ordered by rarity
and only those prefixes are joined. Length, position and a parity sketch of the sets drop pairs
that can't reach the overlap; the rest is verified on the full sets. A line goes if an earlier
one (by doc_id, then line number) is equal or similar.

Words are hashes of 59 bits with five more for their length. Where order matters they are codes,
most rare first: a rarity class from a fixed-size table of counts over all lines, then longer
words, then the hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import lookup, may_be_in, stored

SIMILARITY = 0.8
#: Counts by hashed word: a table of fixed size, whatever the corpus.
BUCKET_BITS = 16
#: Words of a set whose sketch is one number; the sketch of a larger one takes two.
NARROW = 64
#: Rounds in which each class meets the first one with the same end of its hashes: least, largest.
ENDS = [F.array_min, F.array_max]
ROUNDS = len(ENDS)


def _place(doc: str) -> Column:
    return F.xxhash64(F.col(doc).cast("long"), "line")


def _lines(docs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, line (from 0) and its words, empty ones among them; lines of documents with a null id
    are left alone. With `wanted` (doc, line) few others than these are cut into words."""
    found = docs.filter("doc_id is not null").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content")
    )
    if wanted is not None:
        found = found.filter(may_be_in(wanted.select(_place("doc").alias("place")), "place", _place("doc_id")))
    # a line without words is known by its characters, so that who needs no words cuts none
    found = found.filter(F.col("content").rlike("[^ \\t\\x0B\\f\\r]"))
    # nearly all lines have blanks alone between their words; one character needs no pattern
    lower, odd = F.lower("content"), F.col("content").rlike("[\\t\\x0B\\f\\r]")
    parts = F.when(odd, F.split(lower, "[ \\t\\x0B\\f\\r]+")).otherwise(F.split(lower, " "))
    # equal lines share their key; equal sets of different lines are found as similar ones
    key = F.struct(F.xxhash64("content").alias("a"), F.hash("content", F.length("content")).alias("b"))
    return found.select("doc_id", "line", key.alias("key"), parts.alias("words"))


def _rarity(docs: DataFrame) -> str:
    """SQL of an array that gives a rarity class, twice the log of a count, for each bucket."""
    # lines don't matter to counts: a text is cut into words at once
    word = docs.filter("doc_id is not null").select(
        F.explode(F.split(F.lower("text"), "[ \\n\\t\\x0B\\f\\r]+")).alias("word")
    )
    bucket = F.shiftrightunsigned(F.xxhash64("word"), 64 - BUCKET_BITS).cast("int")
    counts = word.filter("word != ''").groupBy(bucket.alias("bucket")).count().collect()
    classes = ["0"] * (1 << BUCKET_BITS)
    for at, n in counts:
        classes[at] = str(int(2 * math.log2(n)))
    return f"cast(split('{','.join(classes)}', ',') as array<bigint>)"


def _sets(lines: DataFrame, rarity: str) -> DataFrame:
    """lines with `hashes` of their distinct words and `words`, the same as sorted codes, most
    rare first."""
    # the five bits say how far the length is from 31; only the empty word has 31 there
    hashes = "array_distinct(transform(words, w -> (xxhash64(w) & -32L) | (31 - least(octet_length(w), 31))))"
    hashes = f"array_remove({hashes}, (xxhash64('') & -32L) | 31L)"
    # no code is null, so that plain numbers are sorted
    code = (
        "sort_array(transform(hashes, h -> "
        f"shiftleft(coalesce(get({rarity}, cast(shiftrightunsigned(h, {64 - BUCKET_BITS}) as int)), 0L), 56)"
        " | shiftleft(h & 31L, 51) | shiftrightunsigned(h, 13)))"
    )
    return lines.withColumn("hashes", F.expr(hashes)).withColumn("words", F.expr(code))


def _least_overlap(n: str, m: str, t: int) -> str:
    """Words that sets of n and m words share at a similarity of t percent, at least."""
    return f"ceil({t} * ({n} + {m}) / {100 + t})"


def _classes(sets: DataFrame, t: int) -> DataFrame:
    """Equal lines as one row: key, n, prefix, sketch (s0, s1), first place, copies, and the
    ends of their hashes."""
    parity = "aggregate(words, 0L, (s, w) -> s ^ if((w & 64) = {}, shiftleft(1L, cast(w & 63 as int)), 0L))"
    whole = "aggregate(words, 0L, (s, w) -> s ^ shiftleft(1L, cast(w & 63 as int)))"
    keyed = sets.select(
        "doc_id",
        "line",
        "key",
        F.size("words").alias("n"),
        F.expr(f"slice(words, 1, size(words) - cast(ceil({t} * size(words) / 100) as int) + 1)").alias("prefix"),
        F.expr(f"if(size(words) > {NARROW}, {parity.format(0)}, {whole})").alias("s0"),
        F.expr(f"if(size(words) > {NARROW}, {parity.format(64)}, 0L)").alias("s1"),
        *(end("hashes").alias(f"end{r}") for r, end in enumerate(ENDS)),
    )
    kept = ["key", "n", "s0", "s1", "prefix", *(f"end{r}" for r in range(ROUNDS))]
    place = F.col("doc_id").cast("decimal(38,0)") * (1 << 32) + F.col("line")
    found = keyed.groupBy(*kept).agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("copies"))
    doc = F.floor(F.col("place") / (1 << 32)).cast("long")
    return found.select(
        *kept, "copies", doc.alias("doc"), (F.col("place") - doc.cast("decimal(38,0)") * (1 << 32)).cast("int").alias("line")
    )


def _possible(t: int, position: bool) -> Column:
    """Whether sets x and y can reach the overlap, y being the earlier."""
    xn, yn = ("x.n", "y.n") if not position else ("shiftright(x.p, 32)", "shiftright(y.p, 32)")
    # two numbers that are folded into one are the sketch that a narrow set has
    differ = (
        f"if(least({xn}, {yn}) > {NARROW}, bit_count(x.s0 ^ y.s0) + bit_count(x.s1 ^ y.s1),"
        " bit_count(x.s0 ^ x.s1 ^ y.s0 ^ y.s1))"
    )
    tests = [
        "(y.doc < x.doc or (y.doc = x.doc and y.line < x.line))",
        f"least({xn}, {yn}) * 100 >= greatest({xn}, {yn}) * {t}",
        f"{xn} + {yn} - {differ} >= 2 * {_least_overlap(xn, yn, t)}",
    ]
    if position:
        # the first word that both share is in both prefixes: none before it is shared
        xi, yi = "(x.p & 2147483647)", "(y.p & 2147483647)"
        tests.insert(2, f"least({xn} - {xi}, {yn} - {yi}) * {100 + t} >= {t} * ({xn} + {yn})")
    return F.expr(" and ".join(tests))


def _verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame, rarity: str, t: int) -> DataFrame:
    """Of the pairs (doc, line, to_doc, to_line) those whose full sets are similar; stored."""
    pairs = stored(spark, pairs.distinct(), "pairs")
    wanted = pairs.select("doc", "line").union(pairs.select("to_doc", "to_line")).distinct()
    wanted = stored(spark, wanted, "wanted")
    near = docs.filter(may_be_in(wanted, "doc", F.col("doc_id").cast("long")))
    sets = _sets(_lines(near, wanted), rarity).select(F.col("doc_id").alias("doc"), "line", F.col("hashes").alias("words"))
    sets = sets.join(wanted, ["doc", "line"])
    sets = stored(spark, sets.dropDuplicates(["doc", "line"]), "sets")
    both = pairs.join(sets.withColumnRenamed("words", "a"), ["doc", "line"]).join(
        sets.toDF("to_doc", "to_line", "b"), ["to_doc", "to_line"]
    )
    common = F.size(F.array_intersect("a", "b"))
    kept = common * 100 >= (F.size("a") + F.size("b") - common) * t
    return stored(spark, both.filter(kept).select("doc", "line", "to_doc", "to_line"), "similar")


def _similar(spark: SparkSession, classes: DataFrame, docs: DataFrame, rarity: str, t: int) -> DataFrame:
    """First places (doc, line) of the classes that an earlier class is similar to."""
    columns = ["doc", "line", "n", "s0", "s1"]
    pairs = None
    for r in range(ROUNDS):
        # most members of a large group are settled by its first one, without pairs among them
        group = classes.groupBy(f"end{r}").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(*columns)).alias("y"))
        group = stored(spark, group.filter("size > 1"), "groups")
        held = lookup(classes.select(f"end{r}", F.struct(*columns).alias("x")), group, f"end{r}", "size")
        some = held.filter("y is not null").filter(_possible(t, False)).select(
            "x.doc", "x.line", F.col("y.doc").alias("to_doc"), F.col("y.line").alias("to_line")
        )
        pairs = some if pairs is None else pairs.union(some)
    settled = _verified(spark, pairs, docs, rarity, t).select("doc", "line").distinct()
    settled = stored(spark, settled, "settled")
    maybe = may_be_in(settled.select(_place("doc").alias("place")), "place", _place("doc"))
    wide = classes.select(*columns, "prefix")
    some = wide.filter(maybe).join(settled.withColumn("settled", F.lit(True)), ["doc", "line"], "left")
    every = some.union(wide.filter(~maybe).withColumn("settled", F.lit(None).cast("boolean")).select(*some.columns))
    placed = every.select(
        *columns, F.coalesce("settled", F.lit(False)).cast("int").alias("settled"), F.posexplode("prefix").alias("i", "word")
    )
    # few and narrow columns in the largest shuffle; both sides of it are alike and share it
    packed = placed.select("word", "doc", "line", "s0", "s1", F.expr("(n * 2L + settled) * 2147483648L + i").alias("p"))
    x, y = packed.alias("x"), packed.alias("y")
    unsettled = F.expr("not (pmod(shiftright(x.p, 31), 2) = 1 and y.p >= 0)")
    met = x.join(y, (F.col("x.word") == F.col("y.word")) & unsettled & _possible(t, True))
    pairs = met.select("x.doc", "x.line", F.col("y.doc").alias("to_doc"), F.col("y.line").alias("to_line"))
    more = _verified(spark, pairs, docs, rarity, t).select("doc", "line")
    return settled.union(more).distinct()


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and lines: the numbers (from 0) of the lines that an earlier line repeats."""
    spark, t = docs.sparkSession, round(100 * similarity)
    lines = _lines(docs.select("doc_id", "text"))
    rarity = _rarity(docs)
    sets = _sets(lines, rarity)
    classes = stored(spark, _classes(sets, t), "classes")
    gone = _similar(spark, classes, docs.select("doc_id", "text"), rarity, t)
    marked = classes.join(gone.withColumn("gone", F.lit(True)), ["doc", "line"], "left").filter(
        "copies > 1 or gone"
    )
    first = (F.col("doc").alias("first_doc"), F.col("line").alias("first_line"))
    marked = stored(spark, marked.select("key", "copies", *first, "gone"), "marked")
    # a line without copies is in its first place; only those with copies are looked up by their text
    alone = marked.filter("copies = 1").select(F.col("first_doc").alias("doc_id"), F.col("first_line").alias("line"))
    copied = marked.filter("copies > 1")
    keyed = lines.select("doc_id", "line", "key")
    keyed = keyed.filter(may_be_in(copied.select(F.xxhash64("key").alias("text")), "text", F.xxhash64("key")))
    held = lookup(stored(spark, keyed, "keyed"), copied, "key", "copies").filter("first_doc is not null")
    first = (F.col("doc_id") == F.col("first_doc")) & (F.col("line") == F.col("first_line"))
    removed = held.filter(F.coalesce("gone", F.lit(False)) | ~first).select("doc_id", "line")
    removed = removed.union(alone.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), "line"))
    return removed.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, removed: str | None = None) -> DataFrame:
    """docs without the lines that repeat an earlier one; all rows and other columns stay.

    A line repeats an earlier one if the Jaccard similarity of their sets of lower-cased words
    is at least `similarity`. Lines without words stay. A text whose lines all go becomes empty,
    a null text stays null, rows with a null doc_id stay as they are and remove nothing. Rows
    of one doc_id share their places, so repeated rows are treated alike. With `removed`, a
    column of that name gives the numbers of the removed lines.
    """
    spark = docs.sparkSession
    gone = stored(spark, repeated_lines(docs, similarity), "gone")
    column = removed or "_removed_lines"
    touched = may_be_in(gone, "doc_id") & F.col("doc_id").isNotNull()
    some = docs.filter(touched).join(gone.withColumnRenamed("lines", column), "doc_id", "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.col(column), i))
    some = some.withColumn("text", F.when(F.col(column).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    rest = docs.filter(~touched).withColumn(column, F.lit(None).cast("array<int>"))
    out = some.select(*rest.columns).union(rest)
    return out if removed else out.drop(column)
