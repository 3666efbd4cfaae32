"""What the operators of this subpackage share: tables, words, stored steps, joins on hot keys."""

from __future__ import annotations

import ctypes
import functools
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.sinks.warehouse import scratch

# A share of all rows that makes a key hot. Fewer keys than this can be hot, so a table of
# hot keys has a proven bound.
HOT_SHARE = 1000
#: Bits of a filter that spares rows a shuffle, and of each of its parts (Spark's bitmaps).
FILTER_BITS, BITMAP_BITS = 1 << 20, 1 << 15


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they start; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as files:
        for file in sorted(package.rglob("*.py")):
            files.write(file, file.relative_to(package.parent))
    uri = f"{scratch(spark).root}/{package.name}.zip"
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        out.write(packed.getvalue())
    context.addPyFile(uri)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str = "step") -> DataFrame:
    """df written to a new folder that all executors share, and read again: cuts the lineage."""
    ship(spark)
    return scratch(spark).write(df, name)


def released(run: Callable) -> Callable:
    """run, a function of batches for mapInArrow, after which its worker gives back the memory that
    allocators keep of a task: workers stay beside the JVM for a while, whatever runs next."""

    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
        if trim:
            trim(0)

    return whole


def batch_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """Per Arrow batch its columns as lists."""
    for batch in batches:
        yield [column.to_pylist() for column in batch.columns]


def few_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many, so that few are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased; other letters stay as they are."""
    return text.lower().split() if text else []


def held_out(modulus: int, remainder: int = 2, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves this remainder. A null id counts as the text ''."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text) % modulus == remainder


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (two rounds of multiply and shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """left LEFT JOIN right on one non-null key, whatever the share of a key in left.

    right holds each key once, with about how many rows of left have it (weight). Keys with
    more than a thousandth of that total are fewer than a thousand rows: they are broadcast.
    The others meet their rows by a shuffle in which no key is hot. Both sides are read twice,
    so store what is dear to compute.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_SHARE > F.lit(total)
    heavy = F.broadcast(right.filter(hot))
    light = right.filter(~hot)
    return left.join(heavy, key, "inner").unionByName(
        left.join(heavy.select(key), key, "left_anti").join(light, key, "left")
    )


def may_be_in(ids: DataFrame, key: str, of: Column | None = None) -> Column:
    """Whether `of` (by default doc_id) may be among these: a filter of fixed size, without
    false negatives.

    Tasks put the bits together. The filter is a subquery on a stored row, not a literal: plans,
    which the driver keeps as text, stay short.
    """

    def place(value) -> tuple[Column, Column]:
        bit = F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))
        return F.shiftright(bit, 15).cast("int"), bit.bitwiseAND(F.lit(BITMAP_BITS - 1))

    part, bit = place(key)
    parts = ids.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    whole = parts.agg(F.map_from_entries(F.collect_list(F.struct("part", "bits"))).alias("bits"))
    part, bit = place(F.col("doc_id") if of is None else of)
    bits = F.element_at(stored(ids.sparkSession, whole, "filter").scalar(), part)
    byte = F.substring(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(value.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0, F.lit(False))


def row_sums(partials: DataFrame) -> dict[int, np.ndarray]:
    """Sums of partial matrices: rows (slot int, v array<double>) added up slot by slot.

    The slots are dealt over the tasks, and a task keeps one sum for each slot it gets, however
    many parts there are. The driver receives the finished sums only.
    """

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, v in zip(batch["slot"].to_pylist(), batch["v"]):
                part = v.values.to_numpy(zero_copy_only=False)
                sums[slot] = sums[slot] + part if slot in sums else part.copy()
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                ["slot", "v"],
            )

    dealt = partials.repartition("slot").mapInArrow(add, "slot int, v array<double>")
    return {slot: np.array(v) for slot, v in dealt.collect()}
