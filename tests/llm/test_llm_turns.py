"""Trie of conversations: brute force over all beginnings, layouts of the radix tree, several ranges and levels, SQL."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultspark.llm import queries, turn_trie
from vaultspark.llm.common import table
from vaultspark.llm.queries import op11_turn_trie, rebuilt

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations, words):
    """Rows of the contract for {conv_id: tuple of turns}; ``words`` gives a turn's word count."""
    members = collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, held in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(held) - 1) * words(p[-1]) if p else 0
    out = []
    for p, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if conversations[c] == p)
        out.append((min(held), len(p), min(members[p[:-1]]) if p else None, len(held), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def turn_id(turn):
    return hashlib.md5(str(turn).encode()).digest()


def by_ranges(conversations, words, sizes):
    """The levels of ``trie`` in plain Python: ``sizes`` rows in each range of a level, the last level in one."""
    keys = collections.defaultdict(list)
    for c, turns in conversations.items():
        keys[turns].append(c)
    rows = [turn_trie.Row(b"".join(map(turn_id, t)), np.array([words(x) for x in t]), len(cs), min(cs),
                          hashlib.sha256(",".join(map(str, sorted(cs))).encode()).digest()) for t, cs in keys.items()]
    nodes = []
    for size in [*sizes, None]:
        rows.sort(key=lambda r: r.key)
        whole = size is None
        parts, nexts = ([rows] if whole else [rows[i:i + size] for i in range(0, len(rows), size)]), []
        for part in parts:
            got, paths = turn_trie.solve(part, whole)
            nodes += list(zip(*got))
            nexts += paths
        rows = nexts
    assert not rows
    parent = {n[4]: n[0] for n in nodes if n[4] is not None}
    return sorted(((n[0], n[1], parent[n[3]] if n[3] is not None else n[2], *n[5:9], (n[9] or turn_trie.EMPTY).hex()) for n in nodes), key=str)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(0, 10**6), st.lists(st.integers(0, 2), max_size=7).map(tuple), min_size=1, max_size=30),
       st.lists(st.integers(1, 5), max_size=3))
def test_ranges_and_levels_against_brute_force(conversations, sizes):
    words = lambda t: t + 2
    assert by_ranges(conversations, words, sizes) == brute(conversations, words)


@pytest.mark.parametrize("fan", [3, 4, 5, 16, 17, 48, 49, 256, 2000])
def test_layouts_grow(fan):
    conversations = {i: (i % fan, i % 7) for i in range(3 * fan)}
    assert by_ranges(conversations, lambda t: 1, [fan]) == brute(conversations, lambda t: 1)
    tree = turn_trie.Tree()
    for i in range(fan):
        tree.insert(bytes([i % 256]) + i.to_bytes(15, "big"), i)
    kind = {1: turn_trie.Few, 2: turn_trie.Some, 3: turn_trie.Many}[1 if fan <= 16 else 2 if fan <= 48 else 3]
    assert isinstance(tree.root.children, kind)
    assert [b for b, _ in tree.root.children] == sorted({i % 256 for i in range(fan)})


def test_ids_that_begin_alike_make_no_node(monkeypatch):
    near = {k: bytes(15) + bytes([k]) for k in range(20)}
    monkeypatch.setitem(globals(), "turn_id", near.__getitem__)
    conversations = {i: (i, (i * 3) % 20) for i in range(20)}
    assert by_ranges(conversations, lambda t: 1, [4]) == brute(conversations, lambda t: 1)


def test_very_long_conversations():
    rng = random.Random(1)
    long = tuple(rng.randrange(9) for _ in range(400))
    conversations = {1: long, 2: long, 3: long[:200], 4: (*long[:300], 77), 5: (), 6: long[:1]}
    assert by_ranges(conversations, lambda t: t, [2, 2]) == brute(conversations, lambda t: t)


def plain_rebuilt(rows):
    """The contract's rebuilding from (conv_id, turn, role, text) rows."""
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    told = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    return {c: tuple([*told.get(c - c % 20, [])[:zlib.crc32(str(c).encode()) % 4], *v[zlib.crc32(str(c).encode()) % 4:]]) for c, v in told.items()}


def n_words(turn):
    return len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", turn[1]) if w])


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [1 << 20, 64])
def test_query_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(turn_trie, "LEAST_BYTES", least)
    monkeypatch.setattr(turn_trie, "CHUNK_IDS", 3)
    monkeypatch.setattr(turn_trie, "FAN", 2)
    held = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SMALL, "conversations").collect()]
    assert rows_of(op11_turn_trie(spark, SMALL)) == brute(plain_rebuilt(held), n_words)


def test_more_partitions_than_asked_for_change_nothing(spark, monkeypatch):
    """A cluster may deal ranges to more partitions, some without rows: levels end all the same."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    deal = Classic.repartitionByRange
    monkeypatch.setattr(Classic, "repartitionByRange", lambda self, n, *cols: deal(self, 37, *cols))
    monkeypatch.setattr(turn_trie, "LEAST_BYTES", 64)
    monkeypatch.setattr(turn_trie, "FAN", 3)
    held = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SMALL, "conversations").collect()]
    assert rows_of(op11_turn_trie(spark, SMALL)) == brute(plain_rebuilt(held), n_words)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "pages"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(f"select {', '.join(df.columns)} from ({queries.ORACLE_SQL[name]}) q").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_thirteen_operators_are_registered():
    assert {int(q[2:].split("_")[0]) for q in queries.QUERIES} == set(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_awkward_rows_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "LEAST_BYTES", 64)
    monkeypatch.setattr(turn_trie, "CHUNK_IDS", 2)
    rows = [(c, t, "user", f"turn {t}") for c in range(40, 90) for t in range(3)]  # many equal conversations
    rows += [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (None, 1, "user", "nobody's"), (2, 5, "a", "x " * 30_000),
             (23, 1, "user", "only one"), (20, 1, "user", "base"), (-5, 0, "user", "hi"), *[(7, t, "user", "again") for t in range(500)]]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' key", "'y' words", "1 n")
    got = turn_trie.trie(spark, rebuilt(turn_trie.sequences(extra)))
    want = plain_rebuilt(rows)
    want[-5] = (("user", "hi"),)[zlib.crc32(b"-5") % 4:]  # % keeps the sign: its base is 0, which is not there
    assert rows_of(got) == brute(want, n_words)
    assert rows_of(turn_trie.trie(spark, rebuilt(turn_trie.sequences(extra.limit(0))))) == []
