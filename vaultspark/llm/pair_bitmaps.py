"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Both tokenizers cut the same bytes.  Where a token of A and a token of B end at
the same byte, the two are linked and a group ends.  The corpus is read once, in
blocks of whole documents: a task gives each document a slot in its block and
writes, for every (A id, B id) pair of the block, compressed bitmaps of slots.
Plane k holds the documents whose number of links of the pair has bit k set, so the
planes OR-merged are the pair's documents, their popcount its document count, and
the planes' popcounts weighted by 2^k its link count.  Blocks are disjoint
stretches of the document space: merging a pair over blocks adds popcounts.

The counts go back through the same postings: each posting takes its pair's count
to its block, where slots sum what they are owed.

Scale: a pair is one row per block however often it occurs, so the most frequent
pair is spread like any other and no shuffle carries tokens or links.  A block
holds at most ``BLOCK_BYTES`` of text (or one longer document) and 2^16 documents.
Only the table of the best count per B id is broadcast: at most one row per id of
B's vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import distinct_names, small_batches, stored, texts

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k", "piece_bpe_32k.model"
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 1 << 16
BATCH_BYTES = 4 << 20
#: A pair is one number: the A id above the B id.
B_BITS = 20
ARRAY, BITSET = 0, 1


# -- the two tokenizers -------------------------------------------------------

class Tokens:
    """Ids and token bytes of both vocabularies, and the texts of groups."""

    def __init__(self, a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(f"{a}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        # the rank file gives the ids of the vocabulary's json file; strings of special tokens stay plain text
        self.a = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.a_bytes[i] = t
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        na, nb = len(self.a_bytes), len(self.b_bytes)
        # an id with what follows it: ',' or '|' after an A id, ',' or ';' after a B id
        self.shown = ([f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)]
                      + [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)])

    def encode(self, whole: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids of space + text, B ids of the text); none if the text is empty or either
        side's bytes are not space + text."""
        none = np.empty(0, dtype=np.int64)
        out = []
        for text, b in zip(whole, self.b.encode(whole, num_threads=1)):
            a = self.a.encode_ordinary(" " + text) if text else []
            want = b" " + text.encode()
            same = bool(text) and want == b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) if same else (none, none))
        return out

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and in ``b`` of the tokens that end at a common byte."""
        _, ia, ib = np.intersect1d(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), assume_unique=True, return_indices=True)
        return ia, ib

    def groups(self, a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the groups in order, each its A ids and its B ids."""
        if not len(a):
            return ""
        na, nb = len(self.a_bytes), len(self.b_bytes)
        closes_a, closes_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        closes_a[ia], closes_b[ib] = 1, 1
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        code = np.concatenate([a + na * closes_a, 2 * na + b + nb * closes_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        return "".join(map(self.shown.__getitem__, code[order].tolist()))[:-1]


@lru_cache(maxsize=2)
def tokens(a: str, b: str) -> Tokens:
    """One pair of tokenizers per Python worker."""
    return Tokens(a, b)


# -- compressed bitmaps -------------------------------------------------------

def planes(slots: np.ndarray, times: np.ndarray) -> bytes:
    """The planes of one pair in one block: for each bit of the multiplicity its kind and length, then
    the sorted slots (2 bytes each) or, where that is shorter, a bit per slot up to the last."""
    out = []
    for bit in range(int(times.max()).bit_length()):
        mine = slots[(times >> bit) & 1 == 1]
        width = (int(mine[-1]) >> 3) + 1 if len(mine) else 0
        if len(mine) * 2 <= width or not len(mine):
            out.append(bytes([ARRAY]) + np.uint32(len(mine)).tobytes() + mine.astype("<u2").tobytes())
        else:
            bits = np.zeros(width * 8, dtype=np.uint8)
            bits[mine] = 1
            out.append(bytes([BITSET]) + np.uint32(width).tobytes() + np.packbits(bits, bitorder="little").tobytes())
    return b"".join(out)


def read_planes(blob: bytes) -> list[np.ndarray]:
    """Slots of each plane."""
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at + 1:at + 5], "little")
        if blob[at] == ARRAY:
            out.append(np.frombuffer(blob, "<u2", n, at + 5).astype(np.int64))
            at += 5 + 2 * n
        else:
            out.append(np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, n, at + 5), bitorder="little")))
            at += 5 + n
    return out


def popcounts(blob: bytes) -> tuple[int, int]:
    """(documents, links) of a posting: the OR of its planes counted, and the planes' counts weighted."""
    links = at = 0
    bits = np.zeros(0, dtype=np.uint8)
    sets, plane = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at + 1:at + 5], "little")
        if blob[at] == ARRAY:
            sets.append(np.frombuffer(blob, "<u2", n, at + 5))
            links += n << plane
            at += 5 + 2 * n
        else:
            one = np.frombuffer(blob, np.uint8, n, at + 5)
            links += int(np.bitwise_count(one).sum()) << plane
            wide, narrow = (bits, one) if len(bits) > len(one) else (one, bits)
            bits = wide.copy()
            bits[:len(narrow)] |= narrow
            at += 5 + n
        plane += 1
    if len(sets) == 1 and not len(bits):
        return len(sets[0]), links
    docs = int(np.bitwise_count(bits).sum())
    if sets:
        loose = np.unique(np.concatenate(sets)).astype(np.int64)
        if len(bits):
            inside = loose[loose < 8 * len(bits)]
            docs -= int(((bits[inside >> 3] >> (inside & 7).astype(np.uint8)) & 1).sum())
        docs += len(loose)
    return docs, links


class Block:
    """Postings of the documents of one block, in memory until the block is full."""

    def __init__(self) -> None:
        self.rows = self.bytes = 0
        self.pairs, self.slots, self.times = [], [], []

    def add(self, pairs: np.ndarray, size: int) -> int:
        slot, self.rows = self.rows, self.rows + 1
        self.bytes += size
        if len(pairs):
            code, times = np.unique(pairs, return_counts=True)
            self.pairs.append(code)
            self.slots.append(np.full(len(code), slot, dtype=np.int64))
            self.times.append(times)
        return slot

    def postings(self) -> tuple[list, list, list, list]:
        """(pair, documents, links, planes) of every pair of the block."""
        if not self.pairs:
            return [], [], [], []
        pair = np.concatenate(self.pairs)
        order = np.argsort(pair, kind="stable")
        pair, slots, times = pair[order], np.concatenate(self.slots)[order], np.concatenate(self.times)[order]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        last = np.append(first[1:], len(pair))
        most = np.maximum.reduceat(times, first)
        head, short = bytes([ARRAY]), slots.astype("<u2").tobytes()
        blobs, docs, links = [], [], []
        for lo, hi, m, top in zip(first.tolist(), last.tolist(), most.tolist(), slots[last - 1].tolist()):
            if m == 1 and (hi - lo) * 2 <= (top >> 3) + 1:  # the usual case: a few documents, one link each
                blob, found = head + (hi - lo).to_bytes(4, "little") + short[2 * lo:2 * hi], (hi - lo, hi - lo)
            else:
                blob = planes(slots[lo:hi], times[lo:hi])
                found = popcounts(blob)
            blobs.append(blob)
            docs.append(found[0])
            links.append(found[1])
        return pair[first].tolist(), docs, links, blobs


# -- the operator -------------------------------------------------------------

@dataclass
class Alignment:
    """``documents``: one row per document with its numbers; ``pairs``: one row per linked id pair with its
    corpus-wide counts; ``postings``: one row per pair and block with its compressed bitmaps."""

    documents: DataFrame
    pairs: DataFrame
    postings: DataFrame

    def occurrences(self) -> DataFrame:
        """(a_id, b_id, block, slot, links): the postings unpacked to the slots of ``documents``."""
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                cols = [[], [], [], []]
                for pair, block, blob in zip(*(b.column(c).to_pylist() for c in ("pair", "block", "planes"))):
                    slot, times = weights(blob)
                    for col, values in zip(cols, ([pair] * len(slot), [block] * len(slot), slot.tolist(), times.tolist())):
                        col.extend(values)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["pair", "block", "slot", "links"])

        out = self.postings.select("pair", "block", "planes").mapInArrow(run, "pair long, block long, slot long, links long")
        return out.select(*ids_of("pair"), "block", "slot", "links")


def ids_of(pair: str) -> list:
    return [F.shiftright(pair, B_BITS).cast("int").alias("a_id"), (F.col(pair).bitwiseAND((1 << B_BITS) - 1)).cast("int").alias("b_id")]


def weights(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and multiplicities of a posting."""
    found = read_planes(blob)
    if len(found) == 1:
        return found[0], np.ones(len(found[0]), dtype=np.int64)
    slot, where = np.unique(np.concatenate(found), return_inverse=True)
    times = np.zeros(len(slot), dtype=np.int64)
    np.add.at(times, where, np.repeat(np.int64(1) << np.arange(len(found)), [len(f) for f in found]))
    return slot, times


SCAN = ("block long, slot int, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "groups_sha256 string, pair long, n_docs long, links long, planes binary")


def align(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = VOCABULARY_A,
          b: str = VOCABULARY_B, keep_groups: bool = True, block_bytes: int = BLOCK_BYTES) -> Alignment:
    """Links of every document and the corpus-wide counts of the id pairs.

    ``documents`` has doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest
    count of its B id, ties included), count_sum (the counts of its links added), groups (null unless
    ``keep_groups``), groups_sha256, block and slot.  A text that is null, empty or not reproduced by both
    vocabularies has no tokens: zeros and ''.  Null ids and repeated rows are documents of their own;
    an empty table gives empty results; no other column is read."""
    src = distinct_names(docs, id_col, text_col)
    schema = SCAN.format(id=src.schema["doc_id"].dataType.simpleString())

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokens(a, b)
        base, count, block = TaskContext.get().partitionId() << 32, 0, Block()
        names = ["block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pair", "n_docs", "links", "planes"]
        kinds = [pa.int64(), pa.int32(), None, *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3, pa.binary()]

        def batch(n: int, id_type: pa.DataType, given: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(given[c], k or id_type) if c in given else pa.nulls(n, k or id_type) for c, k in zip(names, kinds)], names)

        def closed(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal block, count
            found = block.postings()
            for lo in range(0, len(found[0]), 20_000):
                part = [c[lo:lo + 20_000] for c in found]
                n = len(part[0])
                yield batch(n, id_type, {"block": [base + count] * n, **dict(zip(("pair", "n_docs", "links", "planes"), part))})
            count, block = count + 1, Block()

        id_type = None
        for rows in small_batches(it, "text", min(BATCH_BYTES, block_bytes)):
            id_type = rows.column("doc_id").type
            raw = texts(rows.column("text"))
            size = sum(map(len, raw))
            if block.rows and (block.bytes + size > block_bytes or block.rows + rows.num_rows > BLOCK_ROWS):
                yield from closed(id_type)
            for at in range(0, rows.num_rows, BLOCK_ROWS):
                if at:
                    yield from closed(id_type)
                here = raw[at:at + BLOCK_ROWS]
                out = {c: [] for c in ("slot", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256")}
                for text, (ta, tb) in zip(here, both.encode([t.decode("utf-8", "replace") for t in here])):
                    ia, ib = both.ends(ta, tb)
                    shown = both.groups(ta, tb, ia, ib)
                    row = (block.add(ta[ia] << B_BITS | tb[ib], len(text)), len(ta), len(tb), len(ia), len(ia),
                           shown if keep_groups else None, hashlib.sha256(shown.encode()).hexdigest() if shown else "")
                    for c, v in zip(out.values(), row):
                        c.append(v)
                yield batch(len(here), id_type, {"block": [base + count] * len(here),
                                                 "doc_id": rows.column("doc_id").slice(at, len(here)), **out})
        if block.rows:
            yield from closed(id_type)

    scanned = stored(spark, src.mapInArrow(scan, schema), "pair-scan")
    found = scanned.filter("slot is not null").select(
        "block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256")
    postings = scanned.filter("pair is not null").select("pair", "block", "n_docs", "links", "planes")
    totals = postings.groupBy("pair").agg(F.sum("n_docs").alias("doc_count"), F.sum("links").alias("link_count"))
    totals = stored(spark, totals.select("pair", *ids_of("pair"), "doc_count", "link_count"), "pair-totals")
    best = totals.groupBy("b_id").agg(F.max("link_count").alias("best_count"))  # at most one row per id of B's vocabulary
    pairs = totals.join(F.broadcast(best), "b_id").select(
        "pair", "a_id", "b_id", "doc_count", "link_count", (F.col("link_count") == F.col("best_count")).alias("is_best"))

    def owed(table: pa.Table) -> pa.Table:
        n_best = np.zeros(BLOCK_ROWS, dtype=np.int64)
        count_sum = np.zeros(BLOCK_ROWS, dtype=np.int64)
        linked = np.zeros(BLOCK_ROWS, dtype=bool)
        for blob, count, top in zip(*(table.column(c).to_pylist() for c in ("planes", "link_count", "is_best"))):
            slot, times = weights(blob)  # a slot occurs once
            linked[slot] = True
            count_sum[slot] += times * count
            if top:
                n_best[slot] += times
        slot = np.flatnonzero(linked)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()] * len(slot), pa.int64()), "slot": pa.array(slot, pa.int32()),
                         "n_best": n_best[slot], "count_sum": count_sum[slot]})

    back = (postings.select("pair", "block", "planes").join(pairs.select("pair", "link_count", "is_best"), "pair")
            .select("block", "planes", "link_count", "is_best").groupBy("block")
            .applyInArrow(owed, "block long, slot int, n_best long, count_sum long"))
    documents = found.join(back, ["block", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups", "groups_sha256", "block", "slot")
    return Alignment(documents, pairs.drop("pair"), postings)
