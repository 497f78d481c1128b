"""Sequence packing by non-negative least squares.

Documents become token pieces: windows that fill a sequence alone, and one
residual per document.  The residuals' length histogram (at most window - 1 bins)
is all the solver sees.  It enumerates shallow combinations of two and three
lengths that fill a window exactly, solves their repeat counts against the
histogram by projected accelerated gradients (non-negative least squares), rounds
them down and takes back what a length lacks.  Residuals that no combination
uses are packed greedily: they form one stream that fills sequence after sequence,
a piece being cut where a sequence ends.  So only the last sequence is not full.

Scale: the driver holds one histogram and the combinations' counts (bounded by
the window, not by the input).  Pieces of one length are numbered in salted
buckets with prefixed totals, and a number finds its combination, repeat and
offset by binary search in those counts; the leftover stream is a prefix sum over
buckets in the same way.  No task holds a length, whatever its share.  All this is
done on rows without token ids; ids are written once with the pieces and meet their
places in one join by piece number.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import distinct_names, numbered, small_batches, stored, texts

WINDOW = 1024
VOCABULARY = "byte_bpe_50k"
END_ID = 0


# -- tokens ---------------------------------------------------------------

class Encoder:
    """Byte-level BPE ids of the public vocabulary: the rank file of the vocabulary gives the
    ids of its ``tokenizers`` file (tests compare both), several times faster."""

    SPECIAL = "<|endoftext|>"

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={self.SPECIAL: len(ranks)})._core_bpe

    def ids(self, text: bytes) -> np.ndarray:
        words = text.decode("utf-8", "replace")
        if self.SPECIAL in words:  # a special token in a text is one id
            got = self.core.encode(words, {self.SPECIAL})
            return np.array(got[0] if isinstance(got, tuple) else got, dtype="<u4")
        return np.array(self.core.encode_ordinary(words), dtype="<u4")


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """(piece, doc_id, row_key, start, length, ids_crc32, doc_tokens, ids): the windows and the
    residual of each document, its closing id included.  ``ids`` (little-endian,
    2 bytes each while they fit, else 4) is kept for residuals, which may be cut
    later, and for windows if ``keep_ids``.  ``row_key`` tells equal ids apart, ``piece`` (task and place) all rows."""
    src = distinct_names(docs, id_col, text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at_piece = Encoder(vocabulary), TaskContext.get().partitionId() << 40
        for b in small_batches(it, "text", 4 << 20):
            doc, key, start, length, crc, total, kept = [], [], [], [], [], [], []
            names = b.column("doc_id").to_pylist()
            for name, text in zip(names, texts(b.column("text"))):
                ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                own = zlib.crc32(text) << 32 | zlib.crc32(repr(name).encode())
                for at in range(0, len(ids), window):
                    part = ids[at:at + window]
                    doc.append(name)
                    key.append(own - (1 << 63))
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
                    kept.append(pack_ids(part) if keep_ids or len(part) < window else None)
            numbers = np.arange(at_piece, at_piece + len(doc), dtype=np.int64)
            at_piece += len(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(doc, b.column("doc_id").type), *(pa.array(c, pa.int64()) for c in (key, start, length, crc, total)),
                 pa.array(kept, pa.binary())], ["piece", "doc_id", "row_key", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return src.mapInArrow(run, f"piece bigint, doc_id {src.schema['doc_id'].dataType.simpleString()}, row_key bigint, start bigint, "
                               "length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary")


def pack_ids(ids: np.ndarray) -> bytes:
    small = len(ids) == 0 or int(ids.max()) < 1 << 16
    return (b"\x02" if small else b"\x04") + ids.astype("<u2" if small else "<u4").tobytes()


def unpack_ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if blob[0] == 2 else "<u4", offset=1).astype("<u4")


# -- combinations ---------------------------------------------------------

def combinations(window: int) -> np.ndarray:
    """All pairs and triples of lengths (1 to window - 1) that fill the window; rows padded with 0."""
    out = [(a, window - a, 0) for a in range(1, window // 2 + 1)]
    for a in range(1, window // 3 + 1):
        b = np.arange(a, (window - a) // 2 + 1)
        out.extend(zip([a] * len(b), b.tolist(), (window - a - b).tolist()))
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def solve(histogram: np.ndarray, window: int = WINDOW, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """(combinations, repeats): non-negative least squares of repeats against the
    histogram, rounded so that no length is used more often than it occurs."""
    combos = combinations(window)
    combos = combos[np.all((histogram[combos] > 0) | (combos == 0), axis=1)]
    if not len(combos):
        return combos, np.empty(0, dtype=np.int64)
    scale = max(1.0, float(histogram.max()))
    h = histogram / scale
    flat, width = combos.ravel(), combos.shape[1]
    degree = np.bincount(flat, minlength=window).astype(float)
    degree[0] = 1.0
    # columns are preconditioned by the least common of their lengths, so that rare lengths converge too
    x = (h[combos] / degree[combos] + 1e9 * (combos == 0)).min(axis=1)
    y, t = x.copy(), 1.0
    # the largest eigenvalue of A'A, by power iteration
    v = np.ones(len(combos))
    for _ in range(30):
        av = np.bincount(flat, weights=np.repeat(v, width), minlength=window)
        av[0] = 0
        v = av[combos].sum(axis=1)
        lip = np.linalg.norm(v)
        v /= lip
    for _ in range(rounds):
        fit = np.bincount(flat, weights=np.repeat(y, width), minlength=window) - h
        fit[0] = 0
        new = np.maximum(0, y - fit[combos].sum(axis=1) / (1.05 * lip))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    repeats = np.floor(np.maximum(x, 0) * scale).astype(np.int64)
    # take back where a length would be used more often than it occurs, then use up what is left, largest need first
    left = histogram - np.bincount(flat, weights=np.repeat(repeats, width), minlength=window).astype(np.int64)
    left[0] = 0
    for length in np.flatnonzero(left < 0):
        users = np.flatnonzero((combos == length).any(axis=1) & (repeats > 0))
        for c in users[np.argsort(-repeats[users], kind="stable")]:
            if left[length] >= 0:  # also when another length gave enough back
                break
            times = int((combos[c] == length).sum())
            back = min(int(repeats[c]), -(-int(-left[length]) // times))
            repeats[c] -= back
            np.add.at(left, combos[c], back)
            left[0] = 0
    ready = np.flatnonzero(np.all((left[combos] > 0) | (combos == 0), axis=1))
    for c in ready[np.argsort(-x[ready], kind="stable")]:
        parts, need = np.unique(combos[c][combos[c] > 0], return_counts=True)
        more = int((left[parts] // need).min())
        if more > 0:
            repeats[c] += more
            left[parts] -= more * need
    used = repeats > 0
    return combos[used], repeats[used]


class Slots:
    """Where the k-th residual of a length goes: the combinations' uses of that length, prefixed."""

    def __init__(self, combos: np.ndarray, repeats: np.ndarray, window: int) -> None:
        base = np.concatenate(([0], np.cumsum(repeats)))
        self.sequences = int(base[-1])
        offset = np.cumsum(combos, axis=1) - combos
        length, uses = combos.ravel(), np.repeat(repeats, combos.shape[1])
        order = np.argsort(length, kind="stable")
        order = order[length[order] > 0]
        self.length, self.uses = length[order], uses[order]
        self.base, self.offset = np.repeat(base[:-1], combos.shape[1])[order], offset.ravel()[order]
        self.first = np.searchsorted(self.length, np.arange(window + 1))
        before = np.cumsum(self.uses) - self.uses
        self.before = before - before[self.first[np.minimum(self.length, window)]] if len(before) else before
        self.total = np.bincount(self.length, weights=self.uses, minlength=window + 1).astype(np.int64)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset); -1 for a residual that no combination uses."""
        seq, off = np.full(len(length), -1, dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for one in np.unique(length):
            lo, hi = self.first[one], self.first[one + 1] if one + 1 < len(self.first) else len(self.length)
            mine = np.flatnonzero((length == one) & (rank < self.total[one]))
            if len(mine):
                s = lo + np.searchsorted(self.before[lo:hi], rank[mine], side="right") - 1
                seq[mine] = self.base[s] + rank[mine] - self.before[s]
                off[mine] = self.offset[s]
        return seq, off


# -- the operator ---------------------------------------------------------

LIGHT = ["piece", "row_key", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         vocabulary: str = VOCABULARY, keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, if ``keep_ids``, ids (see ``unpack_ids``).  Every id of every document, its
    closing id included, lies in exactly one piece; the offsets of a sequence have no gap; all
    sequences but the last are full.  A null or empty text is its closing id alone;
    repeated rows and null ids are documents of their own; an empty table gives an
    empty result; other columns are not read."""
    all_pieces = stored(spark, pieces(docs, id_col, text_col, window, vocabulary, keep_ids), "pieces")
    id_type = all_pieces.schema["doc_id"].dataType.simpleString()
    sizes = {r["length"]: r["count"] for r in all_pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    histogram = np.zeros(window, dtype=np.int64)
    for n, c in sizes.items():
        if n < window:
            histogram[n] = c
    combos, repeats = solve(histogram, window)
    slots = Slots(combos, repeats, window)
    n_full = sizes.get(window, 0)

    # places are found for rows without ids: those stay in the stored table until the place is known
    spread = ["row_key", "doc_id", "start", "piece"]
    ranked = numbered(spark, all_pieces.select(*LIGHT), ["length"], spread, out="rank", rows=sum(sizes.values()))
    after_full = n_full + slots.sequences

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            seq, off = slots.place(np.minimum(length, window), rank)
            whole = length == window
            seq = np.where(whole, rank, np.where(seq >= 0, seq + n_full, -1))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in LIGHT), pa.array(seq), pa.array(np.where(whole, 0, off))],
                                             [*LIGHT, "sequence_id", "offset"])

    light = (f"piece bigint, row_key bigint, doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")
    placed = stored(spark, ranked.mapInArrow(place, light), "placed")
    done = placed.filter("sequence_id >= 0")
    left_count = int((histogram - slots.total[:window]).sum())
    if left_count:
        rest = placed.filter("sequence_id < 0").select(*LIGHT)
        stream = numbered(spark, rest, [], spread, weight=F.col("length"), out="at", rows=left_count)
        stream = stored(spark, stream.select(*LIGHT, (F.floor(F.col("at") / window) + after_full).alias("sequence_id"),
                                             (F.col("at") % window).alias("offset")), "stream")
        done = done.unionByName(stream)
    crossing = F.col("offset") + F.col("length") > window
    with_ids = all_pieces.select("piece", "ids")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for name, start, length, crc, total, seq, off, blob in zip(*(b.column(c).to_pylist() for c in NAMES)):
                room = window - off
                ids = unpack_ids(blob)
                for lo, hi, s, o in ((0, room, seq, off), (room, length, seq + 1, 0)):
                    rows.append((name, start + lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()), total, s, o, pack_ids(ids[lo:hi])))
            c = list(zip(*rows)) or [[]] * len(NAMES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], b.column("doc_id").type), *(pa.array(x, pa.int64()) for x in c[1:7]), pa.array(c[7], pa.binary())], NAMES)

    out = (f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
           "offset bigint, ids binary")
    halves = done.filter(crossing).join(with_ids, "piece").select(*NAMES).mapInArrow(cut, out)
    whole = done.filter(~crossing)
    if keep_ids:
        return whole.join(with_ids, "piece").select(*NAMES).union(halves)
    return whole.select(*NAMES[:-1]).union(halves.drop("ids"))
