"""The prefix trie against a dictionary of all prefixes, over blocks of every size."""

from __future__ import annotations

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from tillstar.llm import prefix_trie

pytest.importorskip("public_tokenizers")

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


def table(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "k", 0) for r in rows], SCHEMA)


def _order(row):
    _, turn, role, text = row
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
    return (turn is not None, turn or 0, digest)


def brute_force(rows):
    rows = [(c, t, role or "", text or "") for c, t, role, text in rows if c is not None]
    told = {}
    for row in sorted(rows, key=_order):
        told.setdefault(row[0], []).append(row[2:])
    whole = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole[c] = told.get(head, [])[:h] + own[h:]
    members = {}
    for c, said in whole.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) or 1
        saved[p] = sum(saved[x] for x in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(whole[c]) == len(p))))
        out.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
            leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def made_up(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(-6, 50):
        for t in range(rng.choice([0, 1, 2, 3, 9, 12])):
            first = t == 0  # one first turn for all
            rows.append((
                c if rng.random() > 0.02 else None, t if rng.random() > 0.05 else None,
                "u" if first else rng.choice(["u", "a", None]), "hello" if first else rng.choice(["", "x", "yé", None]),
            ))
    return rows + rows[:9]


@pytest.mark.parametrize("most", [1, 2, 7, 1 << 14])
def test_equals_a_dictionary_of_prefixes(spark, most):
    rows = made_up(most)
    assert got(prefix_trie.conversation_trie(table(spark, rows), most)) == brute_force(rows)


def test_one_conversation_many_times(spark):
    """Equal conversations spread over many blocks: one chain, one hash over all ids."""
    rows = [(c * 5, t, "u", f"t{t}") for c in range(300) for t in range(3)]
    assert got(prefix_trie.conversation_trie(table(spark, rows), 16)) == brute_force(rows)


def test_conversations_without_turns(spark):
    # none of these has a head, so the short ones lose all their turns
    rows = [(c, 0, "u", "x") for c in range(1, 40) if c % 5]
    want = brute_force(rows)
    assert got(prefix_trie.conversation_trie(table(spark, rows))) == want
    assert any(r[1] == 0 for r in want)


def test_one_long_conversation(spark):
    rows = [(0, t, "u", f"{t % 7}") for t in range(3000)] + [(5, t, "u", f"{t % 7}") for t in range(1500)]
    assert got(prefix_trie.conversation_trie(table(spark, rows))) == brute_force(rows)


def test_no_conversations(spark):
    assert got(prefix_trie.conversation_trie(table(spark, []))) == []
    assert got(prefix_trie.conversation_trie(table(spark, [(None, 0, "u", "x")]))) == []


def test_role_and_text_stay_apart(spark):
    rows = [(0, 0, "ab", "c"), (5, 0, "a", "bc")]
    assert len(got(prefix_trie.conversation_trie(table(spark, rows)))) == len(brute_force(rows)) == 3


def test_extents_equal_a_scan():
    rng = np.random.default_rng(5)
    lcp = rng.integers(0, 5, 70)
    lcp[0] = 0
    lcps = prefix_trie.sparse_table(lcp)
    for at in range(70):
        for depth in range(1, 6):
            left = at
            while left > 0 and lcp[left] >= depth:
                left -= 1
            right = at
            while right < 69 and lcp[right + 1] >= depth:
                right += 1
            one, d = np.array([at]), np.array([depth])
            assert prefix_trie.left_extent(lcps, one, d)[0] == left
            assert prefix_trie.right_extent(lcps, one, d)[0] == right
            low = prefix_trie.range_minimum(lcps, np.array([left]), np.array([right]))[0]
            assert low == lcp[left : right + 1].min()


def test_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from tillstar.llm.queries import TRIE_SQL, op13_prefix_trie

    data = "/root/testdata/sf0.001"
    Path(data).exists() or pytest.skip("no driver tables")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{data}/conversations.parquet'")
    out = op13_prefix_trie(spark, data)
    want = con.sql(TRIE_SQL)
    assert out.columns == want.columns
    assert got(out) == sorted(want.fetchall(), key=str)
