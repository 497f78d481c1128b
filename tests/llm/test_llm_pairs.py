"""Pair bitmaps: brute force over all links with the two libraries, bitmaps against plain counts, awkward rows."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vaultspark.llm import pair_bitmaps
from vaultspark.llm.common import table
from vaultspark.llm.queries import op12_pair_bitmaps

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(other)}


def brute(libraries, texts):
    """Every column of the contract for a list of texts, and the count of every pair."""
    a, b = libraries
    of = byte_table()
    docs, counts = [], collections.Counter()
    for text in texts:
        if not text:
            docs.append(None)
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        raw_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
            docs.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        links = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f] if len(ids_a) < 500 else \
            [(x, dict(zip(ends_b, ids_b))[e]) for x, e in zip(ids_a, ends_a) if e in set(ends_b)]
        groups, start = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(",".join(str(x) for x, e in zip(ids_a, ends_a) if start < e <= end) + "|"
                          + ",".join(str(x) for x, e in zip(ids_b, ends_b) if start < e <= end))
            start = end
        docs.append((len(ids_a), len(ids_b), groups, links))
        counts.update(links)
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, counts


SHORT = ["a", "Hello world", "Hello  world\n", None, "", " ", "<|endoftext|> and <s></s> <0x0A>", "▁mark", "naïve 漢字🙂 é", "x" * 3000,
         "the the the the the", "the the the the the", "tab\tand\r\nline", "\x00\x01", "don't 12345 67", "of the of the"]


@pytest.mark.parametrize("block_bytes", [1, 40, 1 << 24])
def test_against_all_links(spark, libraries, block_bytes):
    docs = spark.createDataFrame(list(enumerate(SHORT)), "doc_id long, text string").coalesce(2)
    got = pair_bitmaps.align(spark, docs, block_bytes=block_bytes)
    want, counts = brute(libraries, SHORT)
    rows = sorted(got.documents.collect(), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == want
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in rows if r.groups)
    pairs = {(r.a_id, r.b_id): r for r in got.pairs.collect()}
    assert {p: r.link_count for p, r in pairs.items()} == counts
    slots = {(r.block, r.slot): r.doc_id for r in rows}
    held = collections.defaultdict(dict)
    for r in got.occurrences().collect():
        held[r.a_id, r.b_id][slots[r.block, r.slot]] = r.links
    assert {p: sum(d.values()) for p, d in held.items()} == counts
    assert {p: len(d) for p, d in held.items()} == {p: r.doc_count for p, r in pairs.items()}


def test_query_against_brute_force(spark, libraries):
    got = {r.doc_id: r for r in op12_pair_bitmaps(spark, SMALL).collect()}
    whole = [r.text for r in table(spark, SMALL, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    want, _ = brute_fast(libraries, whole)
    assert [tuple(got[i][c] for c in COLUMNS) for i in sorted(got)] == want


def brute_fast(libraries, texts):
    """:func:`brute` with dictionaries of ends instead of all pairs of tokens, for whole tables."""
    a, b = libraries
    of = byte_table()
    docs, counts = [], collections.Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
            docs.append(None)
            continue
        ends_b = dict(zip(np.cumsum([len(x) for x in raw_b]).tolist(), range(len(ids_b))))
        links, groups, from_a, from_b = [], [], 0, 0
        for k, end in enumerate(np.cumsum([len(x) for x in raw_a]).tolist()):
            if end in ends_b:
                j = ends_b[end]
                links.append((ids_a[k], ids_b[j]))
                groups.append(",".join(map(str, ids_a[from_a:k + 1])) + "|" + ",".join(map(str, ids_b[from_b:j + 1])))
                from_a, from_b = k + 1, j + 1
        docs.append((len(ids_a), len(ids_b), groups, links))
        counts.update(links)
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == best[p[1]] for p in d[3]), sum(counts[p] for p in d[3]),
             hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in docs], counts


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 2000), st.integers(1, 300), min_size=1, max_size=400))
def test_planes_hold_slots_and_multiplicities(held):
    slots = np.array(sorted(held), dtype=np.int64)
    times = np.array([held[s] for s in sorted(held)], dtype=np.int64)
    blob = pair_bitmaps.planes(slots, times)
    back = pair_bitmaps.weights(blob)
    assert dict(zip(back[0].tolist(), back[1].tolist())) == held
    assert pair_bitmaps.popcounts(blob) == (len(held), sum(held.values()))


def test_dense_planes_are_compressed():
    slots = np.arange(4096, dtype=np.int64)
    assert len(pair_bitmaps.planes(slots, np.ones(4096, dtype=np.int64))) < 600


def test_awkward_rows(spark):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (2, None, "x"), (None, "", "x"), (None, "one", "x"), (5, "word " * 60_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair string").selectExpr("*", "'a' block", "'b' slot", "'c' planes", "'d' links")
    got = pair_bitmaps.align(spark, docs, keep_groups=False).documents.collect()
    assert sorted((str(r.doc_id), r.n_a > 0) for r in got) == sorted((str(i), bool(t)) for i, t, _ in rows)
    none = pair_bitmaps.align(spark, docs.limit(0))
    assert none.documents.collect() == [] and none.pairs.collect() == []
