"""The trie of shared conversation prefixes, from sorted conversations and range minima.

A conversation is a path: one digest per turn, 16 bytes each. Paths are sorted over all tasks, so
the members of every prefix lie side by side. A block of sorted paths holds the lengths of common
prefixes of neighbours (LCPs) and a sparse table of their range minima. For each prefix a binary
search to the left and one to the right in that table, independent of all other prefixes, give its
member interval. A prefix whose interval doesn't touch an edge of its block is complete, with its
whole subtree. What touches an edge are prefixes of the block's first or last path only: those
few parts are added up over blocks by the digest of the prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import lookup, stored

#: Bytes of a digest; a block holds at most so many paths and about so many turns.
WIDTH, PATHS, TURNS = 16, 1 << 14, 1 << 18
#: A text of joined ids is handed on in parts of about so many ids.
IDS = 512
NO_ONE = hashlib.sha256(b"").hexdigest()

_BLOCK = (
    "kind string, block long, part int, side int, depth int, key binary, parent_key binary, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, ends string"
)
_FIELDS = [f.split()[0] for f in _BLOCK.split(", ")]
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn; the length keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, WIDTH)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, bytes) of every row with a conv_id; null role or text is empty."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", turn_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("bytes")
    )


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, bytes) per conversation: the digests of its turns end to end, and the UTF-8
    bytes of each turn's text. Turns with the same number are ordered by digest."""
    one = F.struct("turn", "digest", "bytes")
    listed = turns(conversations).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))

    def part(name: str) -> Column:
        return F.transform("t", lambda x: x[name])

    joined = F.unhex(F.array_join(F.transform(part("digest"), F.hex), ""))
    return listed.select("conv_id", joined.alias("path"), part("bytes").alias("bytes"))


def family(conv_id: Column) -> Column:
    return conv_id - conv_id % 5


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Paths of the rebuilt conversations: the first h turns of the family's head, conversation
    c - c % 5, then c's own turns after its first h; h = crc32(c) % 9."""
    whole = paths(conversations).withColumn("family", family(F.col("conv_id")))
    together = whole.groupBy("family").agg(F.collect_list(F.struct("conv_id", "path", "bytes")).alias("all"))
    head = F.try_element_at(F.filter("all", lambda x: x["conv_id"] == F.col("family")), F.lit(1))
    each = together.select(head.alias("head"), F.explode("all").alias("own"))
    h = (F.crc32(F.col("own.conv_id").cast("string")) % 9).cast("int")
    first = F.substring(F.coalesce("head.path", F.lit(b"")), F.lit(1), h * WIDTH)
    after = F.substring("own.path", h * WIDTH + 1, F.octet_length("own.path"))
    sizes = F.concat(
        F.slice(F.coalesce("head.bytes", F.array().cast("array<long>")), F.lit(1), h),
        F.slice("own.bytes", h + 1, F.size("own.bytes")),
    )
    return each.select("own.conv_id", F.concat(first, after).alias("path"), sizes.alias("bytes"))


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima over runs of 1, 2, 4, ... values; entry k at i covers values[i : i + 2**k]."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def range_minimum(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of values[first..last], both ends included."""
    level = np.log2(last - first + 1).astype(np.int64)
    out = np.empty(len(first), table[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << k) + 1])
    return out


def right_extent(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last path that shares `depth` turns with path `at`; lcp[i] is between i - 1 and i."""
    end = at.copy()
    for k in range(len(table) - 1, -1, -1):
        ok = end + (1 << k) < len(table[0])
        ok[ok] = table[k][end[ok] + 1] >= depth[ok]
        end[ok] += 1 << k
    return end


def left_extent(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first path that shares `depth` turns with path `at`."""
    begin = at.copy()
    for k in range(len(table) - 1, -1, -1):
        ok = begin >= 1 << k
        ok[ok] = table[k][begin[ok] - (1 << k) + 1] >= depth[ok]
        begin[ok] -= 1 << k
    return begin


def neighbour_lcps(digests: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turns that each path shares with the one before it; 0 for the first."""
    common = np.minimum(size[1:], size[:-1])
    lcp = np.zeros(len(size), np.int64)
    if common.sum():
        first = np.cumsum(common) - common
        place = np.arange(common.sum()) - np.repeat(first, common)
        same = (digests[np.repeat(start[1:], common) + place] == digests[np.repeat(start[:-1], common) + place]).all(axis=1)
        stop = np.where(same, np.repeat(common, common), place)
        some = np.flatnonzero(common)
        lcp[some + 1] = np.minimum.reduceat(stop, first[some])
    return lcp


def _prefix_keys(path: bytes) -> list[bytes]:
    """A digest of every prefix, the empty one first."""
    state, keys = hashlib.sha256(), []
    for at in range(0, len(path) + 1, WIDTH):
        keys.append(state.copy().digest()[:WIDTH])
        state.update(path[at : at + WIDTH])
    return keys


def block_nodes(number: int, conv: np.ndarray, path: list[bytes], bytes_: list[np.ndarray]) -> Iterator[dict]:
    """Rows of one block of sorted paths: complete nodes, parts of open ones, its two edge paths."""
    m = len(conv)
    size = np.array([len(p) // WIDTH for p in path], np.int64)
    start = np.cumsum(size) - size
    digests = np.frombuffer(b"".join(path), np.uint64).reshape(-1, 2)
    weight = np.concatenate(bytes_) if m else np.zeros(0, np.int64)
    lcp = neighbour_lcps(digests, start, size)
    lcps, ids = sparse_table(lcp), sparse_table(conv)

    # a candidate per distinct prefix, where it is met first: the root, then by path and depth
    count = size - lcp
    count[0] += 1
    off = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(np.arange(m), count)
    depth = np.arange(off[-1]) - off[at] + lcp[at] + (at > 0)
    left, right = left_extent(lcps, at, depth), right_extent(lcps, at, depth)
    n = right - left + 1
    smallest = range_minimum(ids, left, right)
    own = np.where(depth > 0, weight[np.maximum(start[at] + depth - 1, 0)] if len(weight) else 0, 0)
    # the parent's interval is searched for by itself; it begins where the parent was met first
    up = np.maximum(depth - 1, 0)
    top = left_extent(lcps, at, up)
    parent = off[top] + up - lcp[top] - (top > 0)
    parent[0] = -1
    open_ = (left == 0) | (right == m - 1)

    children = np.bincount(parent[1:], minlength=len(at))
    closed = ~open_
    under = np.bincount(parent[1:][closed[1:]], minlength=len(at))  # complete children
    leaf = closed & (children == 0)
    saved = np.where(closed, (n - 1) * own, 0)
    cum_leaf, cum_saved = (np.concatenate([[0], np.cumsum(x)]) for x in (leaf, saved))
    end = off[right + 1]  # a subtree's candidates follow its top one by one
    index = np.arange(len(at))
    leaves, all_saved = cum_leaf[end] - cum_leaf[index], cum_saved[end] - cum_saved[index]

    # conversations that end at a node are the first of its interval, ordered by id
    new = np.ones(m, bool)
    new[1:] = (lcp[1:] != size[1:]) | (size[1:] != size[:-1])
    run = np.flatnonzero(new)
    ends_of = dict(zip(run.tolist(), np.append(run[1:], m).tolist()))
    final = size[at] == depth

    first_keys, last_keys = _prefix_keys(path[0]), _prefix_keys(path[-1])
    key_of = {}
    for i in np.flatnonzero(open_):
        key_of[i] = first_keys[depth[i]] if left[i] == 0 else last_keys[depth[i]]

    def text(i: int) -> list[str]:
        """The ids that end at candidate i, joined, in parts."""
        if not final[i]:
            return []
        some = conv[at[i] : ends_of[int(at[i])]].tolist()
        return [",".join(map(str, some[k : k + IDS])) for k in range(0, len(some), IDS)]

    facts = {
        "depth": depth, "conv_id": smallest, "n_convs": n, "n_children": np.where(open_, under, children),
        "n_leaves": leaves, "saved_tokens": all_saved, "bytes": own,
    }
    facts = {name: x.tolist() for name, x in facts.items()}
    parents = parent.tolist()
    for i in range(len(at)):
        row = {name: x[i] for name, x in facts.items()}
        above = parents[i]
        if not open_[i]:
            joined = ",".join(text(i))
            row["ends"] = hashlib.sha256(joined.encode()).hexdigest() if joined else NO_ONE
            if open_[above]:
                yield row | {"kind": "top", "key": key_of[above]}
            else:
                yield row | {"kind": "done", "parent_conv_id": facts["conv_id"][above]}
        else:
            names = {"block": number, "key": key_of[i], "parent_key": key_of[above] if above >= 0 else None}
            yield row | names | {"kind": "part"}
            for part, some in enumerate(text(i)):
                yield names | {"kind": "ends", "part": part, "ends": some}
    for side, keys in ((0, first_keys), (1, last_keys)):
        for d, key in enumerate(keys):
            yield {"kind": "edge", "block": number, "side": side, "depth": d, "key": key}


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_ARROW = [(f.split()[0], _KINDS[f.split()[1]]) for f in _BLOCK.split(", ")]


def _as_batches(rows: Iterator[dict], most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in held], k) for c, k in _ARROW], _FIELDS)

    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield batch()
            held = []
    if held:
        yield batch()


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A partition of sorted paths, block by block. Blocks are numbered in their order."""
    number = TaskContext.get().partitionId() << 32

    def rows():
        nonlocal number
        conv: list[int] = []
        path: list[bytes] = []
        sizes: list[np.ndarray] = []
        held = 0
        for batch in batches:
            lists = batch["bytes"]
            values, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for i, (c, p) in enumerate(zip(batch["conv_id"].to_pylist(), batch["path"].to_pylist())):
                if conv and (len(conv) >= most or held >= TURNS):
                    yield from block_nodes(number, np.array(conv, np.int64), path, sizes)
                    number += 1
                    conv, path, sizes, held = [], [], [], 0
                conv.append(c)
                path.append(p)
                sizes.append(values[offsets[i] : offsets[i + 1]].copy())
                held += len(p) // WIDTH
        if conv:
            yield from block_nodes(number, np.array(conv, np.int64), path, sizes)

    yield from _as_batches(rows())


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) sorted by key and place: the hash of each key's texts, joined by commas. Only
    the state of one hash is held."""
    last, state = None, None
    for batch in batches:
        found = []
        for key, text in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
            if key != last:
                if last is not None:
                    found.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.binary()), pa.array([s for _, s in found], pa.string())], ["key", "ends_sha256"]
        )
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def _open_nodes(blocks: DataFrame) -> DataFrame:
    """The prefixes on edges of blocks, added up over blocks, with their whole subtrees."""
    spark = blocks.sparkSession
    parts, edges = blocks.filter("kind = 'part'"), blocks.filter("kind = 'edge'")
    # each prefix belongs to one edge path: the first that holds it
    owner = edges.groupBy("key").agg(F.min(F.struct("block", "side")).alias("owner"), F.count(F.lit(1)).alias("weight"))
    # equal numbers in all parts of a key; min is as good as any
    merged = parts.groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("closed_children"),
        F.sum("n_leaves").alias("closed_leaves"), F.sum("saved_tokens").alias("closed_saved"), F.min("bytes").alias("bytes"),
    )
    merged = stored(spark, merged.join(owner, "key"), "merged")
    above = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    own = merged.join(above, "key", "left").select(
        "key", "owner", "weight",
        (F.col("closed_children") + F.coalesce("open_children", F.lit(0))).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    own = own.withColumn("leaf", (F.col("n_children") == 0).cast("long"))

    # along an edge path, what its own prefixes from a depth on add to the subtree at that depth
    mine = (F.col("block") == F.col("owner.block")) & (F.col("side") == F.col("owner.side"))
    on_path = lookup(edges.select("key", "block", "side", "depth"), own, "key", "weight")
    deeper = Window.partitionBy("block", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = on_path.select(
        "key",
        F.sum(F.when(mine, F.col("leaf")).otherwise(0)).over(deeper).alias("leaf"),
        F.sum(F.when(mine, F.col("saved")).otherwise(0)).over(deeper).alias("saved"),
    ).groupBy("key").agg(F.sum("leaf").alias("open_leaves"), F.sum("saved").alias("open_saved"))

    texts = blocks.filter("kind = 'ends'").select("key", "block", "part", "ends")
    hashes = texts.repartition("key").sortWithinPartitions("key", "block", "part").select("key", "ends")
    hashes = hashes.mapInArrow(_hash_runs, "key binary, ends_sha256 string")
    parent = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (
        merged.join(own.select("key", "n_children"), "key")
        .join(below, "key")
        .join(hashes, "key", "left")
        .join(parent, "parent_key", "left")
        .select(
            "key", "closed_children", "conv_id", F.col("depth").cast("long"), "parent_conv_id", "n_convs", "n_children",
            (F.col("closed_leaves") + F.col("open_leaves")).alias("n_leaves"),
            (F.col("closed_saved") + F.col("open_saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ONE)).alias("ends_sha256"),
        )
    )


def trie(sequences: DataFrame, most: int = PATHS) -> DataFrame:
    """Every distinct prefix of paths (conv_id, path, bytes), one row each, as longs and a hash:

    conv_id, its smallest member; depth; parent_conv_id (null for the root); n_convs, its members;
    n_children; n_leaves, childless prefixes in its subtree; saved_tokens, over its subtree
    (n_convs - 1) times the bytes of a prefix's last turn; ends_sha256, of the joined ids of the
    members that end there. Subtrees include their top. Conversations without turns are members of
    the root. Without conversations there is no prefix.

    A block of at most `most` paths is in memory, never a prefix's members. The hash of ids is sequential by nature,
    so the ids that end at one prefix stream through one task, joined by then.
    """
    spark = sequences.sparkSession
    held = stored(spark, sequences, "paths")
    ordered = held.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    blocks = stored(spark, ordered.select("conv_id", "path", "bytes").mapInArrow(lambda b: _blocks(b, most), _BLOCK), "blocks")
    opened = stored(spark, _open_nodes(blocks), "open")

    tops = blocks.filter("kind = 'top'").drop("parent_conv_id")
    above = opened.select("key", F.col("conv_id").alias("parent_conv_id"), F.col("closed_children").alias("weight"))
    closed = blocks.filter("kind = 'done'").select(*_FIELDS)
    closed = closed.unionByName(lookup(tops, above.filter("weight > 0"), "key", "weight").select(*_FIELDS))
    return closed.withColumnRenamed("ends", "ends_sha256").withColumn("depth", F.col("depth").cast("long")).select(_NODE).unionByName(
        opened.select(_NODE)
    )


def conversation_trie(conversations: DataFrame, most: int = PATHS) -> DataFrame:
    """The prefixes of rebuilt conversations (conv_id, turn, role, text).

    Rows are ordered by turn, null first, then by digest; repeated rows are turns like others; null
    role or text is empty; rows without conv_id take no part. Other columns are ignored, whatever
    they are called. Texts are read once; after that a turn is 24 bytes. A conversation's
    turns, and those of its family of five, are in one task at that size.
    """
    return trie(rebuilt(conversations.select("conv_id", "turn", "role", "text")), most)
