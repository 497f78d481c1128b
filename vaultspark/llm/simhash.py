"""SimHash near-duplicates with Golay-code fuzzy hashing.

A document's 64-bit fingerprint has a bit set where more than half of its word
shingles' XXH64 values have it.  Two fingerprints link at ``max_bits`` (4) or
fewer differing bits; documents of one connected component form a group.

Candidates come from the perfect binary Golay code [23, 12, 7].  The
fingerprint is cut into three segments (22, 21 and 21 bits, zero-padded to 23).
Every 23-bit word lies within 3 bits of exactly one codeword; decoding a
segment and all its one-bit changes yields one to six codeword indices of 12
bits.  Pigeonhole: with at most 4 errors over three segments, the two segments
with the fewest have at most 2 together.  So for one of the three segment
pairs some word lies within one bit of both fingerprints' pairs, and both emit
the pair of indices that this word decodes to: about 29 keys of 24 bits per
fingerprint lose no link.  Equal keys meet and are verified by XOR and bit count:
up to three members of a key inside the aggregate that counts it, more in a sorted
exchange.

Scale: equal fingerprints are one row first (map-side aggregate).  Keys that
many fingerprints share are counted, and such a bucket is cut into blocks whose
pairs are separate groups, so no task holds a bucket.  Each group emits a
spanning forest of its links, never the pairs.  Components use the large-star /
small-star algorithm over written edge tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import distinct_names, small_batches, stored, texts

#: Generator polynomial of the binary Golay code (fixed value).
GOLAY_POLY = 0xC75
#: Widths of the fingerprint's segments, from the lowest bit.
SEGMENTS = (22, 21, 21)
#: Members of one verification group; larger buckets are cut into block pairs.
GROUP = 1024
#: Shingles hashed at a time (work space of one very long text).
CHUNK = 1 << 16


# -- fingerprints ---------------------------------------------------------

def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of a whole text (UTF-8)."""
    flat = b" ".join(text.lower().split())  # bytes.lower() changes A-Z only, split() cuts at 0x20 and 0x09-0x0D
    if not flat:
        return 0
    raw = np.frombuffer(flat, dtype=np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(flat)]))
    if len(starts) <= words:
        return xxhash.xxh64_intdigest(flat, seed)
    starts, ends = starts[: len(starts) - words + 1], ends[words - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), CHUNK):
        h = np.array([digest(flat[a:b], seed) for a, b in
                      zip(starts[k:k + CHUNK].tolist(), ends[k:k + CHUNK].tolist())], dtype=np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    on = ones * 2 > len(starts)
    return int(np.packbits(on, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the fingerprint's bits as a signed long."""
    src = distinct_names(docs, id_col, text_col)
    id_type = src.schema["doc_id"].dataType

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(it, "text", 16 << 20):
            fp = np.array([fingerprint(t, words) for t in texts(b.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return src.mapInArrow(run, f"doc_id {id_type.simpleString()}, fp bigint")


# -- Golay keys -----------------------------------------------------------

def _remainders() -> np.ndarray:
    """x^i modulo the generator polynomial, for the 23 bits."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= GOLAY_POLY
    return np.array(out, dtype=np.int64)


class Golay:
    """Nearest-codeword decoding by a table of the 2048 coset leaders."""

    def __init__(self) -> None:
        rem = _remainders()
        self.low, self.high = self._sums(rem[:12]), self._sums(rem[12:])
        self.leader = np.zeros(2048, dtype=np.int64)
        n = np.arange(23)
        for x in [0, *(1 << n), *((1 << a) | (1 << b) for a in n for b in n[:a]),
                  *((1 << a) | (1 << b) | (1 << c) for a in n for b in n[:a] for c in n[:b])]:
            self.leader[self.low[x & 0xFFF] ^ self.high[x >> 12]] = x

    @staticmethod
    def _sums(rem: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << len(rem), dtype=np.int64)
        for i, r in enumerate(rem):
            out[1 << i: 2 << i] = out[: 1 << i] ^ r
        return out

    def index(self, words: np.ndarray) -> np.ndarray:
        """12-bit index (information bits) of the nearest codeword."""
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.leader[syndrome]) >> 11


def golay_keys(fp: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints (uint64), each key once per row."""
    near, shift = [], 0
    for width in SEGMENTS:
        seg = ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        flips = np.concatenate(([0], 1 << np.arange(width)))
        near.append(code.index(seg[:, None] ^ flips[None, :]))
        shift += width
    parts = []
    for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        both = np.concatenate(((near[i] << 12) | near[j][:, :1], (near[i][:, :1] << 12) | near[j]), axis=1)
        parts.append(both | (p << 24))
    keys = np.sort(np.concatenate(parts, axis=1), axis=1)
    first = np.ones(keys.shape, dtype=bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    rows = np.nonzero(first)[0]
    return rows, keys[first]


def _key_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code = Golay()
    for b in it:
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        for k in range(0, len(fp), 4096):
            part = fp[k:k + 4096]
            rows, keys = golay_keys(part.view(np.uint64), code)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


# -- verification ---------------------------------------------------------

def forest(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, smaller fp) of all verified links inside runs of equal ``group`` (sorted)."""
    n = len(fp)
    label = np.arange(n)
    bits = fp.view(np.uint64)
    run_start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if n else np.empty(0, np.int64)
    length = np.diff(np.concatenate((run_start, [n])))
    left = np.repeat(length, length) - (np.arange(n) - np.repeat(run_start, length)) - 1  # members after this one
    us, vs, here = [], [], np.arange(n)
    for lag in range(1, int(length.max()) if n else 0):
        here = here[left[here] >= lag]
        near = here[np.bitwise_count(bits[here] ^ bits[here + lag]) <= max_bits]
        if len(near):
            us.append(near)
            vs.append(near + lag)
    if not us:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    u, v = np.concatenate(us), np.concatenate(vs)
    while True:  # smallest position reachable, with pointer jumping
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(n)
    return fp[moved], fp[label[moved]]


def _verifier(max_bits: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_g, keep_f = np.empty(0, np.int64), np.empty(0, np.int64)

        def out(g, f):
            a, b = forest(g, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

        for b in it:
            g = np.concatenate((keep_g, b.column("grp").to_numpy(zero_copy_only=False)))
            f = np.concatenate((keep_f, b.column("fp").to_numpy(zero_copy_only=False)))
            if not len(g):
                continue
            last = int(np.flatnonzero(g == g[-1])[0])  # the last run may go on in the next batch
            if last:
                yield out(g[:last], f[:last])
            keep_g, keep_f = g[last:], f[last:]
        if len(keep_g):
            yield out(keep_g, keep_f)

    return run


def links(spark: SparkSession, fps: DataFrame, max_bits: int = 4, group: int = GROUP) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints ``fps(fp)`` at ``max_bits`` (4 at most) or fewer bits."""
    if max_bits > 4:
        raise ValueError("three segments and these keys find links of up to 4 bits")
    keys = fps.mapInArrow(_key_rows, "key bigint, fp bigint")
    buckets = keys.groupBy("key").agg(F.count("*").alias("count"), F.min("fp").alias("a"), F.max("fp").alias("b"),
                                      F.bit_xor("fp").alias("x"))
    # up to three members are known from their smallest, largest and XOR, and verified here; chance meetings end at this point
    near = lambda p, q: F.bit_count(p.bitwiseXOR(q)) <= max_bits
    a, b = F.col("a"), F.col("b")
    mid = F.when(F.col("count") == 3, F.col("x").bitwiseXOR(a).bitwiseXOR(b)).otherwise(a)
    met_few = [F.struct(p.alias("u"), q.alias("v")) for p, q in ((a, b), (a, F.col("c")), (F.col("c"), b))]
    few = buckets.filter("count between 2 and 3").withColumn("c", mid).filter(near(a, b) | ((F.col("count") == 3) & (near(a, F.col("c")) | near(F.col("c"), b))))
    few = few.select(F.explode(F.filter(F.array(*met_few), lambda e: near(e["u"], e["v"]) & (e["u"] != e["v"]))).alias("e")).select("e.u", "e.v")
    counts = buckets.filter("count > 3").select("key", "count")
    # the tasks make about 87 keys of a fingerprint, which no estimate of ``keys`` knows: neither side may be broadcast by its estimate
    met = keys.join(counts.hint("merge"), "key")
    blocks = F.ceil(F.col("count") / F.lit(group // 2))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    met = met.withColumn("blocks", F.when(F.col("count") > group, blocks).otherwise(F.lit(1))).withColumn("own", own)
    # a block meets every other block (and there its own members); an uncut bucket is one group
    met = met.withColumn("other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long")))
                                            .otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                                                                lambda o: o != F.col("own")))))
    grp = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    met = met.select(grp.alias("grp"), "fp")
    return (met.repartition("grp").sortWithinPartitions("grp")
            .mapInArrow(_verifier(max_bits), "u bigint, v bigint").union(few))


# -- components -----------------------------------------------------------

def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each node's connected component, for
    all nodes in ``edges(u, v)``.  Alternating large-star and small-star steps;
    each round is written to the shared folder."""
    def state(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = stored(spark, edges.filter("u != v").distinct(), "edges")
    seen = state(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = stored(spark, small.filter("u != v").distinct(), "edges")
        now = state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 4, max_bits: int = 4, group: int = GROUP) -> DataFrame:
    """(doc_id, fp, component_id, root): one row per row of ``docs``; root is the
    group's smallest fingerprint.

    component_id is the smallest doc_id reachable over links, itself included.
    Texts that are null, empty or without words share fingerprint zero.  Repeated
    rows stay repeated.  A null doc_id keeps its row, is never a component_id
    unless its whole component has no id (then that is null).  An empty table
    gives an empty result; other columns are not read."""
    fps = stored(spark, fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = stored(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    tree = components(spark, links(spark, classes.select("fp"), max_bits, group))
    rooted = classes.join(tree, classes.fp == tree.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = stored(spark, rooted.join(best, "root").select("fp", "component_id", "root"), "component")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id", "root")


def hex_fingerprint(c: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(c)), 16, "0"))


def deduplicate(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each group: the one whose id is the group's
    smallest, rows without an id last.  Of several texts under that id the one with the smallest
    hash stays; repeated rows of that id and text leave one (the smallest by its columns in order)."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    sha = F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))
    # a document is an id with a text: the same id may stand for texts of different groups
    named = docs.select(F.struct(key.isNull().alias("nameless"), key.alias("id"), sha.alias("sha")).alias("_doc"), text.alias("_text"))
    found = near_duplicates(spark, named, "_doc", "_text", words, max_bits)
    first = stored(spark, found.filter(F.col("doc_id") == F.col("component_id"))
                   .groupBy("doc_id").agg(F.count("*").alias("copies")), "first")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])

    def rows(copies: str) -> DataFrame:
        ids = first.filter(copies).select(F.col("doc_id.id").alias("_rep_id"), F.col("doc_id.sha").alias("_rep_sha"))
        return docs.join(ids, key.eqNullSafe(F.col("_rep_id")) & (sha == F.col("_rep_sha")), "left_semi")

    return rows("copies = 1").union(
        rows("copies > 1").groupBy(key.alias("_rep_id"), sha.alias("_rep_sha")).agg(F.min(whole).alias("_row")).select("_row.*"))
