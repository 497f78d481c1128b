"""Language-model scores from an Elias-Fano n-gram trie.

A model of order n (two and three words, or more) with absolute discounting, interpolated down to an add-one
unigram base:
P(w | u v) = max(c(uvw) - D, 0) / c(uv) + D * N(uv) / c(uv) * P(w | v) and
P(w | v) = max(c(vw) - D, 0) / c(v) + D * N(v) / c(v) * (c(w) + 1) / (N + V + 1),
N being the distinct followers of a context; each sums to one over the V known tokens and one
unknown.  A text is scored as its words and an end token, the first word after
an end; no context reaches before that end.

The trie's first level is the lexicon: 64-bit word hashes in order and their exact counts, as prefix sums.
The second level holds, for the contexts of a segment in order, monotone
pointers to their children and the children's ids, shifted by the last id of the context
before so that the whole level is one increasing sequence.  Its children are the nodes of the level: the third
level holds a pointer for each of them and their children, shifted likewise, and so on to the
order.  Hashes, counts, contexts, pointers and
children are Elias-Fano sequences; discounted probabilities and back-off weights are
quantised to 8 bits.  A query finds its node, reads the two pointers' shift and
searches the successor of the shifted id; the node it finds is the context of the next word one level deeper.

Scale: all n-grams are counted over all learning texts, none is pruned.  Each task
aggregates its counts in numpy and emits one compressed block per segment, so the
exchange moves few large rows; a segment's blocks are merged by one task and written as
files in the shared folder, where scoring tasks map them into memory.  The number
of segments follows the input's bytes, which bounds the work space of a merge.  A
context so frequent that it would fill a segment is split over several by its
follower; an n-gram lies in the segment of its first two words at every level.  Words are told apart by 64-bit hashes (two of ten million words
collide with a chance of 3 in a million).
"""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.bytewords import Hasher, Part, pieces
from vaultspark.llm.common import distinct_names, scratch, small_batches, stored, texts
from vaultspark.llm.eliasfano import EliasFano

DISCOUNT = 0.75
#: Bytes of learning text per segment of a level.
SEGMENT_BYTES = 32 << 20
#: Distinct entries that a task holds before it emits them.
HELD = 2_000_000
PIECE = 4 << 20
LEVELS = 255
#: Bytes of segments that a reader of a level keeps in its heap; mapped files take none.
OPEN_BYTES = 128 << 20


# -- files in the shared folder -------------------------------------------

def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def write_arrays(root: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One .npy file per array; each is complete before it has its name, and a second attempt replaces it by the same."""
    files, base = _store(root)
    files.create_dir(base, recursive=True)
    for key, a in arrays.items():
        final, part = f"{base}/{name}-{key}.npy", f"{base}/_{TaskContext.get().taskAttemptId()}-{name}-{key}"
        with files.open_output_stream(part) as out:
            head = io.BytesIO()
            np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(a))
            out.write(head.getvalue())
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if a.size else b"")
        if files.type_name != "local" and files.get_file_info(final).type.name != "NotFound":
            files.delete_file(final)
        files.move(part, final)


def read_array(root: str, name: str, key: str) -> np.ndarray:
    """The array, mapped into memory where the store is a file system of this machine."""
    files, base = _store(root)
    path = f"{base}/{name}-{key}.npy"
    if files.type_name == "local":
        a = np.load(path, mmap_mode="r")
        return a.view(np.ndarray)
    with files.open_input_stream(path) as f:
        return np.load(io.BytesIO(f.read()))


class Open:
    """Segments read by ``load`` (which gives a value and its arrays); beyond ``OPEN_BYTES`` of heap the least
    recently used are dropped, so that the memory of a task does not follow the model's size."""

    def __init__(self, load) -> None:
        self.load, self.held, self.size = load, OrderedDict(), 0

    def __getitem__(self, k: int):
        if k in self.held:
            self.held.move_to_end(k)
            return self.held[k][0]
        value, arrays = self.load(k)
        n = sum(a.nbytes for a in arrays if not isinstance(a.base, np.memmap))
        while self.held and n and self.size + n > OPEN_BYTES:
            self.size -= self.held.popitem(last=False)[1][1]
        self.held[k] = value, n
        self.size += n
        return value


def sequence(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of an Elias-Fano sequence, by the names they are stored under."""
    e = EliasFano.build(values)
    return {f"{name}-{x}": a for x, a in zip(("low", "high", "ones", "zeros"), e.arrays())} | {f"{name}-shape": np.array([e.n, e.width], dtype=np.int64)}


def read_sequence(root: str, file: str, name: str) -> EliasFano:
    return EliasFano(*read_array(root, file, f"{name}-shape").tolist(), *(read_array(root, file, f"{name}-{x}") for x in ("low", "high", "ones", "zeros")))


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their total counts.  The list is emptied, so that its arrays can go."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    parts.clear()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    counts = counts[order]
    del order
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one occurrence of every distinct key, in order of the keys; place of each key among them)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate((np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]))
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def by_number(seg: np.ndarray) -> np.ndarray:
    """Stable order of segment numbers; numbers of 16 bits are sorted by counting."""
    return np.argsort(seg.astype(np.uint16) if len(seg) and seg.max() < 1 << 16 else seg, kind="stable")


class Held:
    """Counts of one task, merged as they come in."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """All counts; nothing is held any more."""
        self.size = 0
        return summed(self.parts) if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))

    def full(self) -> bool:
        """Whether there is too much to hold even after a merge."""
        if self.size < HELD:
            return False
        k, c = self.merged()
        self.parts, self.size = [(k, c)], len(k)
        return self.size >= HELD // 2


def blocks(seg: np.ndarray, keys: np.ndarray, counts: np.ndarray, second: bool) -> Iterator[tuple[int, int, bytes]]:
    """(segment, entries, compressed arrays); keys of second-level blocks are cut into context and child."""
    order = by_number(seg)  # keys stay in order inside a segment
    seg, keys, counts = seg[order], keys[order], counts[order].astype(np.uint64)
    ends = np.flatnonzero(np.concatenate((seg[1:] != seg[:-1], np.ones(min(1, len(seg)), bool)))) + 1
    start = 0
    for end in ends:
        k, c = keys[start:end], counts[start:end]
        if second:
            up = k >> np.uint64(32)
            parts = (np.diff(up, prepend=np.uint64(0)).astype("<u4"), (k & np.uint64(0xFFFFFFFF)).astype("<u4"), c)
        else:
            parts = (k, c)
        yield int(seg[start]), end - start, packed(*parts)
        start = end


def opened(n: int, blob: bytes, second: bool) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=n * 16 + 16)
    if second:
        up = np.cumsum(np.frombuffer(raw, "<u4", n).astype(np.uint64))
        return (up << np.uint64(32)) | np.frombuffer(raw, "<u4", n, n * 4).astype(np.uint64), np.frombuffer(raw, "<u8", n, n * 8).astype(np.int64)
    return np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<u8", n, n * 8).astype(np.int64)


BLOCK = "seg int, entries bigint, block binary"


def _block_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    seg, n, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(seg, pa.int32()), pa.array(n, pa.int64()), pa.array(blob, pa.binary())],
                                      ["seg", "entries", "block"])


def _merge(table: pa.Table, second: bool) -> tuple[np.ndarray, np.ndarray]:
    got = [opened(n, b, second) for n, b in zip(table.column("entries").to_pylist(), table.column("block").to_pylist())]
    return summed(got)


# -- quantisation ---------------------------------------------------------

def quantised(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, codebook) of log10 probabilities: equal steps over their range, each standing for its members' mean."""
    if not len(p):
        return np.empty(0, np.uint8), np.zeros(1)
    x = np.log10(p)
    low, step = x.min(), max(x.max() - x.min(), 1e-12) / LEVELS
    code = np.minimum((x - low) / step, LEVELS).astype(np.uint8)
    n = np.bincount(code, minlength=LEVELS + 1)
    return code, np.bincount(code, weights=x, minlength=LEVELS + 1) / np.maximum(n, 1)


# -- the model ------------------------------------------------------------

def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Model:
    """Numbers and places of a model; the levels stay in files under ``root``.

    ``base``: first id of each lexicon segment; ``hot``: contexts split over several
    segments, ``ways``: over how many, ``back``: their back-off weights; ``nodes``: for each level from
    the second, the number of its first node in every segment."""

    root: str
    bits: int
    base: np.ndarray
    documents: int
    tokens: int
    segments: int = 1
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ways: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    back: np.ndarray = field(default_factory=lambda: np.empty(0))
    filled: tuple[int, ...] = ()
    order: int = 2
    nodes: dict[int, np.ndarray] = field(default_factory=dict)

    @property
    def end(self) -> int:
        """Id of the end token: the one after the words."""
        return int(self.base[-1])

    @property
    def vocabulary(self) -> int:
        return self.end + (self.documents > 0)

    @property
    def total(self) -> float:
        """Denominator of the unigram base."""
        return float(self.tokens + self.vocabulary + 1)

    def key_bits(self, level: int) -> int:
        """Bits of a word behind the number of a node of ``level`` in a 64-bit key."""
        bits = int(self.end + 1).bit_length()
        if int(self.nodes[level][-1]).bit_length() + bits > 64:
            raise ValueError(f"more nodes of level {level} and words than a 64-bit key")
        return bits

    def place(self, prev: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Segment of the second level for each pair of ids."""
        out = mixed(prev)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, prev), len(self.hot) - 1)
            split = np.flatnonzero(self.hot[at] == prev)
            out[split] += mixed(word[split]) % self.ways[at[split]].astype(np.uint64)
        return (out % np.uint64(self.segments)).astype(np.int64)


def segment_start(k: int, bits: int) -> np.uint64:
    """The least hash of a lexicon segment."""
    return np.uint64(k << (64 - bits) if bits else 0)


def times(sums: EliasFano, at: np.ndarray) -> np.ndarray:
    """Counts at positions of their prefix sums."""
    return (sums.get(at + 1) - sums.get(at)).astype(np.int64)


class Lexicon:
    """First level: ids and counts of word hashes."""

    def __init__(self, model: Model) -> None:
        self.m, self.open = model, Open(self.load)

    def load(self, k: int) -> tuple:
        s = tuple(read_sequence(self.m.root, f"words-{k:06d}", x) for x in ("hash", "count"))
        return s, [a for e in s for a in e.arrays()]

    def segment(self, k: int) -> tuple[EliasFano, EliasFano]:
        return self.open[k]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of sorted distinct hashes; -1 and 0 for an unknown word."""
        ids, counts = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        seg = (hashes >> np.uint64(64 - self.m.bits)).astype(np.int64) if self.m.bits else np.zeros(len(hashes), dtype=np.int64)
        cuts = np.searchsorted(seg, np.arange((1 << self.m.bits) + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            if self.m.base[k + 1] == self.m.base[k]:
                continue
            known, count = self.segment(int(k))
            part = slice(cuts[k], cuts[k + 1])
            at = known.find(hashes[part] - segment_start(int(k), self.m.bits))
            hit = np.flatnonzero(at >= 0)
            ids[part.start + hit] = at[hit] + self.m.base[k]
            counts[part.start + hit] = times(count, at[hit])
        return ids, counts

    def count(self, ids: np.ndarray) -> np.ndarray:
        """Counts of known ids (the end token's is the number of documents)."""
        out = np.full(len(ids), self.m.documents, dtype=np.int64)
        seg = np.searchsorted(self.m.base, ids, side="right") - 1
        for k in np.unique(seg[ids < self.m.end]):
            mine = np.flatnonzero((seg == k) & (ids < self.m.end))
            out[mine] = times(self.segment(int(k))[1], ids[mine] - self.m.base[k])
        return out


@dataclass
class Tokens:
    """Tokens of a part of the texts, ends included: ``row``, ``id`` (-1: unknown), ``count``, and the id before each.

    ``first``: the first token of each text here, ``fresh``: whether its text begins here; ``open``: whether the
    last text goes on in the next part, with its last token here (1), without one so far (0) or without one here (-1)."""

    row: np.ndarray
    id: np.ndarray
    count: np.ndarray
    prev: np.ndarray
    first: np.ndarray
    fresh: np.ndarray
    open: int


class Reader:
    """Texts to tokens; remembers the last word of a text that goes on in the next part."""

    def __init__(self, model: Model) -> None:
        self.m, self.hasher, self.lexicon, self.carry = model, Hasher(), Lexicon(model), -1

    def tokens(self, part: Part) -> Tokens:
        w = self.hasher.words(part.texts)
        known, inverse = np.unique(w.hash, return_inverse=True)
        ids, counts = self.lexicon.find(known)
        # room for an end after the last word of every text that ends here
        owner = np.concatenate((w.row, np.flatnonzero(part.tail)))
        token = np.concatenate((ids[inverse], np.full(int(part.tail.sum()), self.m.end)))
        count = np.concatenate((counts[inverse], np.full(int(part.tail.sum()), self.m.documents)))
        order = np.argsort(owner, kind="stable")
        owner, token, count = owner[order], token[order], count[order]
        prev = np.concatenate(([-1], token[:-1])) if len(token) else token
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1])))
        prev[first] = np.where(part.head[owner[first]], self.m.end, self.carry)
        fresh, open_ = part.head[owner[first]], -1
        if not part.tail[-1]:
            if len(owner) and owner[-1] == len(part.rows) - 1:
                self.carry, open_ = int(token[-1]), 1
            elif part.head[-1]:
                self.carry, open_ = self.m.end, 0  # no word of it so far
        return Tokens(part.rows[owner], token, count, prev, first, fresh, open_)


def learn(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learn_from: Column | None = None,
          discount: float = DISCOUNT, segment_bytes: int = SEGMENT_BYTES, order: int = 2) -> Model:
    """A model of all texts for which ``learn_from`` (an expression over doc_id) holds; ``order``: words of the
    longest n-grams, 2 or more."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    src = distinct_names(docs, id_col, text_col)
    src = (src if learn_from is None else src.filter(learn_from)).select("text")
    size = src.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    n_bytes, documents = size["b"] or 0, size["n"]
    wanted = max(1, -(-n_bytes // segment_bytes))
    bits = int(wanted - 1).bit_length()
    root = scratch(spark, "ngrams")

    def count_words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(), Held()

        def out() -> pa.RecordBatch:
            k, c = held.merged()
            seg = (k >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), dtype=np.int64)
            return _block_batch(list(blocks(seg, k, c, False)))

        for b in small_batches(it, "text", 16 << 20):
            for part in pieces(texts(b.column("text")), PIECE):
                held.add(*np.unique(hasher.words(part.texts).hash, return_counts=True))
                if held.full():
                    yield out()
        yield out()

    def write_words(table: pa.Table) -> pa.Table:
        k, c = _merge(table, False)
        seg = table.column("seg")[0].as_py()
        write_arrays(root, f"words-{seg:06d}", sequence("hash", k - segment_start(seg, bits)) | sequence("count", np.concatenate(([0], np.cumsum(c)))))
        return pa.table({"seg": pa.array([seg], pa.int32()), "n": pa.array([len(k)], pa.int64()), "total": pa.array([int(c.sum())], pa.int64())})

    lexicon = stored(spark, src.mapInArrow(count_words, BLOCK).groupBy("seg").applyInArrow(write_words, "seg int, n bigint, total bigint"), "lexicon")
    parts = {r["seg"]: r for r in lexicon.collect()}  # one row per segment
    base = np.concatenate(([0], np.cumsum([parts[k]["n"] if k in parts else 0 for k in range(1 << bits)])))
    tokens = sum(r["total"] for r in parts.values()) + documents
    if base[-1] >= (1 << 32) - 1:
        raise ValueError("more words than 32-bit ids")
    model = Model(root, bits, base, documents, tokens, segments=wanted, order=order)
    if not documents:
        model.order = 2  # no level has a node
        return model

    # contexts that would fill a quarter of a segment or more; at most four per segment
    limit = max(1, tokens // (4 * wanted))

    def frequent(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for seg in b.column("seg").to_pylist():
                sums = read_sequence(root, f"words-{seg:06d}", "count")
                c = np.diff(sums.get(np.arange(sums.n))).astype(np.int64)
                at = np.flatnonzero(c > limit)
                yield pa.RecordBatch.from_arrays([pa.array(at + base[seg]), pa.array(np.asarray(c[at]))], ["id", "n"])

    many = lexicon.repartition(max(1, min(wanted, lexicon.count())), "seg").mapInArrow(frequent, "id bigint, n bigint").collect()
    many = sorted([(r["id"], r["n"]) for r in many] + ([(model.end, documents)] if documents > limit else []))
    if wanted > 1 and many:
        model.hot = np.array([i for i, _ in many], dtype=np.int64)
        model.ways = np.array([min(wanted, -(-4 * n // limit)) for _, n in many], dtype=np.int64)

    def count_pairs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = Reader(model), Held()

        def out() -> pa.RecordBatch:
            k, c = held.merged()
            seg = model.place((k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64))
            return _block_batch(list(blocks(seg, k, c, True)))

        for b in small_batches(it, "text", 16 << 20):
            for part in pieces(texts(b.column("text")), PIECE):
                t = reader.tokens(part)
                held.add(*np.unique((t.prev.astype(np.uint64) << np.uint64(32)) | t.id.astype(np.uint64), return_counts=True))
                if held.full():
                    yield out()
        yield out()

    hot = model.hot

    def write_pairs(table: pa.Table) -> pa.Table:
        k, c = _merge(table, True)
        seg = table.column("seg")[0].as_py()
        prev, word = (k >> np.uint64(32)).astype(np.int64), k & np.uint64(0xFFFFFFFF)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(prev)), bool), prev[1:] != prev[:-1])))
        context, fan = prev[first], np.diff(np.concatenate((first, [len(prev)])))
        times = Lexicon(model).count(context)
        # each context's ids start above the last one of the context before
        top = word[np.concatenate((first[1:], [len(word)])) - 1] + np.uint64(1)
        shift = np.concatenate((np.zeros(1, np.uint64), np.cumsum(top)[:-1].astype(np.uint64)))
        code, book = quantised((c - discount) / np.repeat(times, fan))
        back, back_book = quantised(discount * fan / times)
        arrays = {"code": code, "book": book, "back": back, "backbook": back_book}
        for name, values in (("context", context), ("pointer", np.concatenate((first, [len(prev)]))), ("child", word + np.repeat(shift, fan))):
            arrays |= sequence(name, values)
        write_arrays(root, f"pairs-{seg:06d}", arrays)
        split = np.isin(context, hot)
        ids = np.concatenate((context[split], [-1]))
        return pa.table({"seg": pa.array(np.full(len(ids), seg, np.int32)), "id": pa.array(ids.astype(np.int64)),
                         "n": pa.array(np.concatenate((fan[split], [len(k)])).astype(np.int64))})

    written = stored(spark, src.mapInArrow(count_pairs, BLOCK).groupBy("seg").applyInArrow(write_pairs, "seg int, id bigint, n bigint"), "pairs")
    filled = {r["seg"]: r["n"] for r in written.filter("id = -1").collect()}
    model.filled = tuple(sorted(filled))
    model.nodes[2] = np.concatenate(([0], np.cumsum([filled.get(k, 0) for k in range(wanted)])))
    if len(hot):  # followers of a split context, over its segments
        fan = {r["id"]: r["n"] for r in written.filter("id >= 0").groupBy("id").agg(F.sum("n").alias("n")).collect()}
        model.back = np.array([discount * fan[i] / n for i, n in many])
    for level in range(3, order + 1):
        _learn_level(spark, src, model, level, discount)
    return model


def _learn_level(spark: SparkSession, src: DataFrame, model: Model, level: int, discount: float) -> None:
    """Count and write the n-grams of ``level`` words below the nodes of the level before."""
    root, above = model.root, model.nodes[level - 1]
    model.key_bits(level - 1)

    def count_children(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, walk, held = Reader(model), Walk(Trie(model), level - 1), Held()
        bits = np.uint64(model.key_bits(level - 1))

        def out() -> pa.RecordBatch:
            k, c = held.merged()
            node, word = (k >> bits).astype(np.int64), k & ((np.uint64(1) << bits) - np.uint64(1))
            seg = np.searchsorted(above, node, side="right") - 1
            return _block_batch(list(blocks(seg, ((node - above[seg]).astype(np.uint64) << np.uint64(32)) | word, c, True)))

        for b in small_batches(it, "text", 16 << 20):
            for part in pieces(texts(b.column("text")), PIECE):
                t = reader.tokens(part)
                node = walk.part(t)
                known = np.flatnonzero(node >= 0)
                held.add(*np.unique((node[known].astype(np.uint64) << bits) | t.id[known].astype(np.uint64), return_counts=True))
                if held.full():
                    yield out()
        yield out()

    def write_children(table: pa.Table) -> pa.Table:
        k, c = _merge(table, True)
        seg = table.column("seg")[0].as_py()
        node, word = (k >> np.uint64(32)).astype(np.int64), k & np.uint64(0xFFFFFFFF)
        del k
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(node)), bool), node[1:] != node[:-1])))
        own, fan = node[first], np.diff(np.concatenate((first, [len(node)])))
        total = np.add.reduceat(c, first)  # a text goes on after every node that has children
        top = word[np.concatenate((first[1:], [len(word)])) - 1] + np.uint64(1)
        shift = np.concatenate((np.zeros(1, np.uint64), np.cumsum(top)[:-1].astype(np.uint64)))
        code, book = quantised((c - discount) / np.repeat(total, fan))
        weight, back_book = quantised(discount * fan / total)
        back = np.zeros(above[seg + 1] - above[seg], dtype=np.uint8)
        back[own] = weight
        arrays = {"code": code, "book": book, "back": back, "backbook": back_book}
        arrays |= sequence("pointer", np.searchsorted(node, np.arange(len(back) + 1)))
        arrays |= sequence("child", word + np.repeat(shift, fan))
        write_arrays(root, f"level{level}-{seg:06d}", arrays)
        return pa.table({"seg": pa.array([seg], pa.int32()), "n": pa.array([len(node)], pa.int64())})

    written = stored(spark, src.mapInArrow(count_children, BLOCK).groupBy("seg").applyInArrow(write_children, "seg int, n bigint"), f"level{level}")
    sizes = {r["seg"]: r["n"] for r in written.collect()}  # one row per segment
    model.nodes[level] = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(model.segments)])))


class Trie:
    """The levels from the second: probabilities of n-grams, read from the segments' files."""

    def __init__(self, model: Model) -> None:
        self.m, self.open, self.filled = model, Open(self.load), set(model.filled)
        self.deeper = {n: Open(lambda k, n=n: self.load_level(n, k)) for n in model.nodes if n > 2}

    def load(self, k: int) -> tuple:
        return self._read(f"pairs-{k:06d}", ("context", "pointer", "child"))

    def load_level(self, level: int, k: int) -> tuple:
        return self._read(f"level{level}-{k:06d}", ("pointer", "child"))

    def _read(self, name: str, sequences: tuple[str, ...]) -> tuple:
        get = lambda key: read_array(self.m.root, name, key)
        s = {x: read_sequence(self.m.root, name, x) for x in sequences}
        rest = {"code": get("code"), "book": np.asarray(get("book")), "back": get("back"), "backbook": np.asarray(get("backbook"))}
        return s | rest, [a for e in s.values() for a in e.arrays()] + list(rest.values())

    def segment(self, k: int) -> dict:
        return self.open[k]

    @staticmethod
    def children(s: dict, own: np.ndarray, known: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(back-off weight, node or -1, probability) of words below the contexts ``own`` of a segment; those that are
        not ``known`` have no children."""
        # the shift of a context: the last child id before its first, in the increasing sequence
        new = np.concatenate((np.ones(min(1, len(own)), bool), own[1:] != own[:-1]))
        each, which = own[new], np.cumsum(new) - 1
        start, stop = s["pointer"].get(each).astype(np.int64), s["pointer"].get(each + 1).astype(np.int64)
        before = s["child"].get(np.maximum(start - 1, 0)) + np.uint64(1)
        shift = np.where(start > 0, before, np.uint64(0))
        known = known & (stop > start)[which]
        back = np.where(known, (10.0 ** s["backbook"])[s["back"][each]][which], 1.0)
        node, seen = np.full(len(own), -1, dtype=np.int64), np.zeros(len(own))
        ask = np.flatnonzero(known & (word >= 0))
        found = s["child"].find(shift[which[ask]] + word[ask].astype(np.uint64))
        hit = (found >= start[which[ask]]) & (found < stop[which[ask]])
        node[ask[hit]] = found[hit]
        seen[ask[hit]] = (10.0 ** s["book"])[s["code"][found[hit]]]
        return back, node, seen

    def pairs(self, prev: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(discounted probability, back-off weight, segment, node) of distinct pairs; node -1: not seen."""
        m, seen, back = self.m, np.zeros(len(prev)), np.ones(len(prev))
        segment, node = np.zeros(len(prev), dtype=np.int64), np.full(len(prev), -1, dtype=np.int64)
        if len(m.hot):
            at = np.minimum(np.searchsorted(m.hot, prev), len(m.hot) - 1)
            split = m.hot[at] == prev
            back[split] = m.back[at[split]]
        else:
            split = np.zeros(len(prev), dtype=bool)
        asked = np.flatnonzero(prev >= 0)  # unknown contexts back off entirely
        segment[asked] = m.place(prev[asked], word[asked])
        for k, mine in by_segment(segment, asked):
            if k not in self.filled:
                continue
            s = self.segment(k)
            context, inverse = np.unique(prev[mine], return_inverse=True)
            place = s["context"].find(context)[inverse]
            weight, node[mine], seen[mine] = self.children(s, np.maximum(place, 0), place >= 0, word[mine])
            plain = ~split[mine]
            back[mine[plain]] = weight[plain]
        return seen, back, segment, node

    def below(self, level: int, segment: np.ndarray, above: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(discounted probability, back-off weight, node) of words below the nodes ``above`` of the level before ``level``."""
        seen, back, node = np.zeros(len(word)), np.ones(len(word)), np.full(len(word), -1, dtype=np.int64)
        held = np.diff(self.m.nodes[level])
        for k, mine in by_segment(segment, np.flatnonzero(above >= 0)):
            if held[k]:
                back[mine], node[mine], seen[mine] = self.children(self.deeper[level][k], above[mine], np.ones(len(mine), dtype=bool), word[mine])
        return seen, back, node

    def log10(self, prev: np.ndarray, word: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 P(word | prev) of distinct pairs; ``base`` is the unigram probability."""
        seen, back, _, _ = self.pairs(prev, word)
        return np.log10(seen + back * base)


def by_segment(segment: np.ndarray, asked: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Indices of each segment among the ``asked`` ones."""
    asked = asked[by_number(segment[asked])]
    mine = segment[asked]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(mine)) + 1, [len(mine)]))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if lo < hi:
            yield int(mine[lo]), asked[lo:hi]


class Walk:
    """Nodes and probabilities of the tokens of consecutive parts, down to level ``depth``; remembers the nodes of the
    last token of a text that goes on in the next part."""

    def __init__(self, trie: Trie, depth: int) -> None:
        self.trie, self.depth, self.p = trie, depth, np.empty(0)
        self.carry = dict.fromkeys(range(2, depth + 1), (0, -1))

    def _contexts(self, t: Tokens, level: int, segment: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's context: the node of the token before it in its text, -1 without one."""
        seg, above = np.concatenate(([0], segment))[:-1], np.concatenate(([-1], node))[:-1]
        seg[t.first], above[t.first] = np.where(t.fresh, 0, self.carry[level][0]), np.where(t.fresh, -1, self.carry[level][1])
        if t.open == 1:
            self.carry[level] = int(segment[-1]), int(node[-1])
        elif t.open == 0:
            self.carry[level] = 0, -1
        return seg, above

    def part(self, t: Tokens, base: np.ndarray | None = None) -> np.ndarray:
        """For each token the number of its context among the nodes of level ``depth``, -1 if there is none.  If their unigram ``base``
        is given, ``p`` are the tokens' probabilities; there is no need of contexts below the last level then."""
        m = self.trie.m
        key = ((t.prev + 1).astype(np.uint64) << np.uint64(32)) | (t.id + 1).astype(np.uint64)
        first, inverse = distinct(key)
        seen, back, segment, node = (x[inverse] for x in self.trie.pairs(t.prev[first], t.id[first]))
        self.p = seen if base is None else seen + back * base
        if m.order == 2:
            return node
        for level in range(2, self.depth + 1):
            if level > 2:
                asked = np.flatnonzero(above >= 0)
                key = (number[asked].astype(np.uint64) << np.uint64(m.key_bits(level - 1))) | (t.id[asked] + 1).astype(np.uint64)
                first, inverse = distinct(key)
                first = asked[first]
                got = self.trie.below(level, segment[first], above[first], t.id[first])
                self.p[asked] = got[0][inverse] + got[1][inverse] * self.p[asked]
                node = np.full(len(t.id), -1, dtype=np.int64)
                node[asked] = got[2][inverse]
            if base is not None and level == m.order:
                return node
            segment, above = self._contexts(t, level, segment, node)
            number = np.where(above >= 0, m.nodes[level][segment] + above, -1)
        return number


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every whole text, one row per
    input row.

    A null or empty text is its end token alone.  Without learning texts every token
    is unknown.  Repeated rows and null ids are scored like any other; an empty table
    gives an empty result; other columns are not read."""
    src = distinct_names(docs, id_col, text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, walk = Reader(model), Walk(Trie(model), model.order)
        for b in small_batches(it, "text", 16 << 20):
            raw = texts(b.column("text"))
            n = len(raw)
            tokens, known = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            base, full = np.zeros(n), np.zeros(n)
            for part in pieces(raw, PIECE):
                t = reader.tokens(part)
                p = (t.count + 1.0) / model.total
                walk.part(t, p)
                tokens += np.bincount(t.row, minlength=n)
                known += np.bincount(t.row, weights=t.count > 0, minlength=n).astype(np.int64)
                base += np.bincount(t.row, weights=np.log10(p), minlength=n)
                full += np.bincount(t.row, weights=np.log10(walk.p), minlength=n)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(tokens), pa.array(known), pa.array(base), pa.array(full)],
                                             ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double")
