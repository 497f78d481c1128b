"""Prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn (role and text) has a 16-byte id, so a conversation is one byte key and the
beginnings it shares with others are common key prefixes.  Equal conversations are
merged first.  The distinct keys are cut into ranges of bounded size; each range is one
task that inserts its keys into an adaptive radix tree: inner nodes grow from 4 over 16
and 48 to 256 children, and a node keeps the bytes up to its first branch.  Walking the
tree from below, only byte depths at a turn's end emit nodes of the trie: depths inside
a kept path too, and none inside an id where two ids merely begin alike.

A node belongs to one range alone unless it begins the first or the last key of a range.
Those few are not emitted; a range hands on its first and its last key with what it knows
of the nodes on them.  The paths of ``FAN`` neighbouring ranges are inserted into one tree
again, level by level, until one holds all: each level has two rows for a whole range of
the level below.

Digests of the members that end at a node are hashed in an aggregate while they are few.
A larger group's ids are sorted and joined into chunks in parallel, and stream through one
hash as few, large rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import stored

#: Bytes of a turn id (of its MD5, big-endian).
WIDTH = 16
#: Bytes of keys in a range; a small table is cut down to ``LEAST_BYTES`` while cores are idle.
RANGE_BYTES, LEAST_BYTES = 4 << 20, 64 << 10
#: Neighbouring ranges whose paths meet in one tree of the next level.
FAN = 64
#: Members whose ids one aggregate may hold; a larger group is hashed from sorted chunks of so many ids.
CHUNK_IDS = 8192
NO_CONV = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").digest()
SALTS = 16


# -- adaptive radix tree ------------------------------------------------------

class Few:
    """Up to ``room`` children, sorted by byte: the layouts of 4 and 16."""

    __slots__ = ("room", "keys", "nodes")

    def __init__(self, room: int = 4) -> None:
        self.room, self.keys, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        i = self.keys.find(byte)
        return None if i < 0 else self.nodes[i]

    def add(self, byte: int, node):
        if len(self.keys) == self.room:
            wider = Few(16) if self.room == 4 else Some()
            for b, n in self:
                wider.add(b, n)
            return wider.add(byte, node)
        i = bisect_left(self.keys, byte)
        self.keys.insert(i, byte)
        self.nodes.insert(i, node)
        return self

    def __iter__(self):
        return iter(zip(self.keys, self.nodes))


class Some:
    """Up to 48 children behind an index of 256 bytes."""

    __slots__ = ("index", "nodes")

    def __init__(self) -> None:
        self.index, self.nodes = bytearray(b"\xff" * 256), []

    def get(self, byte: int):
        i = self.index[byte]
        return None if i == 255 else self.nodes[i]

    def add(self, byte: int, node):
        if len(self.nodes) == 48:
            wider = Many()
            for b, n in self:
                wider.add(b, n)
            return wider.add(byte, node)
        self.index[byte] = len(self.nodes)
        self.nodes.append(node)
        return self

    def __iter__(self):
        return ((b, self.nodes[i]) for b, i in enumerate(self.index) if i != 255)


class Many:
    """A slot for each of 256 children."""

    __slots__ = ("nodes",)

    def __init__(self) -> None:
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def add(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """``path``: the bytes between the branch byte above and the node's end; ``row``: what ends there."""

    __slots__ = ("path", "children", "row")

    def __init__(self, path: bytes, row=None) -> None:
        self.path, self.children, self.row = path, None, row

    def child(self, byte: int):
        return None if self.children is None else self.children.get(byte)

    def attach(self, byte: int, node: "Node") -> None:
        self.children = (Few() if self.children is None else self.children).add(byte, node)


def common(path: bytes, key: bytes, at: int) -> int:
    """Leading bytes that ``path`` and ``key[at:]`` share, by halving."""
    lo, hi = 0, min(len(path), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if path[lo:mid] == key[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Tree:
    """Adaptive radix tree of byte keys; equal keys share a node, whose rows are a list."""

    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, row) -> None:
        if self.root is None:
            self.root = Node(key, [row])
            return
        node, at = self.root, 0
        while True:
            same = common(node.path, key, at)
            if same < len(node.path):  # the kept path splits here
                lower = Node(node.path[same + 1:], node.row)
                lower.children = node.children
                branch = node.path[same]
                node.path, node.children, node.row = node.path[:same], None, None
                node.attach(branch, lower)
            at += same
            if at == len(key):
                node.row = [row] if node.row is None else [*node.row, row]
                return
            below = node.child(key[at])
            if below is None:
                node.attach(key[at], Node(key[at + 1:], [row]))
                return
            node, at = below, at + 1

    def trace(self, key: bytes) -> list[Node]:
        """Nodes from the root to the end of a key that was inserted."""
        out, at, node = [], 0, self.root
        while True:
            out.append(node)
            at += len(node.path)
            if at == len(key):
                return out
            node, at = node.child(key[at]), at + 1


# -- one range ----------------------------------------------------------------

class Row:
    """A key with the words of its turns, and either what ends at it (``n`` members, smallest ``conv``, digest)
    or, from a level below, ``part``: n, conv, children, leaves, saved of every depth, and digests."""

    __slots__ = ("key", "words", "n", "conv", "ends", "part", "_prints")

    def __init__(self, key, words, n=0, conv=NO_CONV, ends=None, part=None) -> None:
        self.key, self.words, self.n, self.conv, self.ends, self.part, self._prints = key, words, n, conv, ends, part, None

    def prints(self) -> list[bytes]:
        """A fingerprint of the key's beginning at every depth."""
        if self._prints is None:
            h = hashlib.blake2b(digest_size=16)
            out = [h.digest()]
            for at in range(0, len(self.key), WIDTH):
                h.update(self.key[at:at + WIDTH])
                out.append(h.copy().digest())
            self._prints = out
        return self._prints


NODE = ["conv_id", "depth", "parent_conv_id", "parent_print", "print", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


class Found:
    """What one range knows of a part of its tree that hangs below some byte depth."""

    __slots__ = ("n", "conv", "children", "leaves", "saved", "tops", "rows", "first")

    def __init__(self) -> None:
        self.n = self.children = self.leaves = self.saved = 0
        self.conv, self.tops, self.rows, self.first = NO_CONV, [], [], None


def solve(rows: list[Row], whole: bool) -> tuple[list[list], list[Row]]:
    """(finished nodes as columns of ``NODE``, paths for the next level).  With ``whole`` no other range
    exists and all nodes are finished."""
    out: list[list] = [[] for _ in NODE]
    if not rows:
        return out, []
    tree = Tree()
    for r in rows:
        tree.insert(r.key, r)
    low, high = min(rows, key=lambda r: r.key), max(rows, key=lambda r: r.key)
    edges: dict[int, Row] = {}
    paths: dict[int, tuple] = {}
    if not whole:
        for r in (high, low):  # nodes on both belong to the low path
            edges.update((id(n), r) for n in tree.trace(r.key))
            t = len(r.key) // WIDTH + 1
            # n, conv, children, leaves, saved; digests
            paths[id(r)] = (r, np.zeros((5, t), dtype=np.int64), [None] * t)
            paths[id(r)][1][1] = NO_CONV
    # nodes in the order of a walk from the root, each with its parent's place and its end
    order: list[tuple[Node, int, int]] = [(tree.root, -1, len(tree.root.path))]
    for place, (node, _, end) in enumerate(order):
        if node.children is not None:
            order.extend((child, place, end + 1 + len(child.path)) for _, child in node.children)
    found = [None] * len(order)
    for place in range(len(order) - 1, -1, -1):
        node, above, end = order[place]
        here = found[place] or Found()
        found[place] = None
        for r in node.row or ():
            here.first = here.first or r
            if r.part is None:
                here.n += r.n
                here.conv = min(here.conv, r.conv)
            else:
                here.rows.append(r)
        edge = edges.get(id(node))
        start = order[above][2] if above >= 0 else -1
        for at in range(end - end % WIDTH, start, -WIDTH):
            depth = at // WIDTH
            n, conv, children, leaves, saved, ends = here.n, here.conv, here.children, here.leaves, here.saved, None
            if at == end:
                ends = next((r.ends for r in node.row or () if r.part is None), None)
            if here.rows:  # members are not added up from below here: every row counts all members of its range
                n, conv = 0, NO_CONV
                for r in here.rows:
                    vals, digests = r.part
                    n += int(vals[0, depth])
                    conv = min(conv, int(vals[1, depth]))
                    children += int(vals[2, depth])
                    leaves += int(vals[3, depth])
                    saved += int(vals[4, depth])
                    ends = ends or digests[depth]
            first = here.first
            if edge is not None:
                _, vals, digests = paths[id(edge)]
                vals[:, depth] = n, conv, children, leaves, saved
                digests[depth] = ends
                for e in here.tops:
                    out[3][e] = first.prints()[depth]
                here.tops, here.children, here.leaves, here.saved = [], 0, 0, 0
                continue
            for e in here.tops:
                out[2][e] = conv
            here.tops = [len(out[0])]
            here.leaves = leaves if children else 1
            here.saved = saved + (n - 1) * (int(first.words[depth - 1]) if depth else 0)
            here.children = 1
            for col, v in zip(out, (conv, depth, None, None, first.prints()[depth] if here.rows else None, n, children,
                                    here.leaves, here.saved, ends)):
                col.append(v)
        if above < 0:
            continue
        if found[above] is None:
            found[above] = Found()
        up = found[above]
        up.n += here.n
        up.conv = min(up.conv, here.conv)
        up.children += here.children
        up.leaves += here.leaves
        up.saved += here.saved
        up.first = up.first or here.first
        # the longer list takes the shorter one in
        for name in ("tops", "rows"):
            a, b = getattr(up, name), getattr(here, name)
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            a.extend(b)
            setattr(up, name, a)
    nexts = []
    for r, vals, digests in {id(p[0]): p for p in paths.values()}.values():
        nexts.append(Row(r.key, r.words, part=(vals, digests)))
    return out, nexts


# -- levels -------------------------------------------------------------------

SCHEMA = ("conv_id long, depth long, parent_conv_id long, parent_print binary, print binary, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends binary, key binary, words binary, part binary, digests binary, shard long")
TYPES = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.int64()] * 4 + [pa.binary()] * 5 + [pa.int64()]
NAMES = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def _read(b: pa.RecordBatch | pa.Table) -> list[Row]:
    """Rows of a batch: keys of the first level, paths of a later one."""
    out = []
    names = set(b.schema.names)
    if "part" not in names:
        for key, words, n, conv, ends in zip(*(b.column(c).to_pylist() for c in ("key", "words", "n", "conv", "ends"))):
            out.append(Row(key, np.array(words, dtype="<i8"), n, conv, ends))
        return out
    for key, words, part, digests in zip(*(b.column(c).to_pylist() for c in ("key", "words", "part", "digests"))):
        t = len(key) // WIDTH + 1
        known = [digests[32 * i:32 * i + 32] for i in range(t)]
        out.append(Row(key, np.frombuffer(words, "<i8"),
                       part=(np.frombuffer(part, "<i8").reshape(5, t), [None if d == bytes(32) else d for d in known])))
    return out


def _written(rows: list[Row], whole: bool, shard: int) -> list[pa.RecordBatch]:
    """Finished nodes and paths of one range."""
    nodes, paths = solve(rows, whole)
    out = []
    for columns in ([*nodes, *[[None] * len(nodes[0]) for _ in range(5)]],
                    [*[[None] * len(paths) for _ in NODE], [r.key for r in paths], [np.asarray(r.words, "<i8").tobytes() for r in paths],
                     [r.part[0].astype("<i8").tobytes() for r in paths], [b"".join(d or bytes(32) for d in r.part[1]) for r in paths],
                     [shard] * len(paths)]):
        for lo in range(0, len(columns[0]), 20_000):
            out.append(pa.RecordBatch.from_arrays([pa.array(c[lo:lo + 20_000], t) for c, t in zip(columns, TYPES)], NAMES))
    return out


def _first_level(spark: SparkSession, keys: DataFrame) -> tuple[DataFrame, bool]:
    """The ranges of a stored table of keys: finished nodes and paths, stored, and whether one range held all."""
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("key")), F.lit(0))).first()
    ranges = max(-(-total // RANGE_BYTES), min(spark.sparkContext.defaultParallelism, total // LEAST_BYTES))
    whole = max(1, min(ranges, rows // 8)) == 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # partitions of a range partitioning are numbered in the order of the keys
        yield from _written([r for b in it for r in _read(b)], whole, TaskContext.get().partitionId())

    ranged = keys.coalesce(1) if whole else keys.repartitionByRange(min(ranges, rows // 8), "key")
    return stored(spark, ranged.mapInArrow(run, SCHEMA), "trie-nodes"), whole


def _next_level(spark: SparkSession, paths: DataFrame) -> tuple[DataFrame, bool]:
    """The paths of ``FAN`` neighbouring ranges meet in one: at most two rows for each."""
    last = paths.agg(F.max("shard")).first()[0]
    whole = last < FAN

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("above")[0].as_py()
        return pa.Table.from_batches(_written(_read(table), whole, shard), pa.schema(list(zip(NAMES, TYPES))))

    above = paths.select("key", "words", "part", "digests", F.floor(F.col("shard") / FAN).alias("above"))
    return stored(spark, above.groupBy("above").applyInArrow(run, SCHEMA), "trie-nodes"), whole


def _digests(spark: SparkSession, members: DataFrame, keys: DataFrame) -> DataFrame:
    """(kid, ends) of keys with several members: SHA-256 of their ids in ascending order, joined by commas."""
    few = members.join(keys.where(f"n between 2 and {CHUNK_IDS}").select("kid"), "kid", "left_semi")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    few = few.groupBy("kid").agg(F.unhex(F.sha2(F.array_join(ids, ",").cast("binary"), 256)).alias("ends"))
    large = keys.where(F.col("n") > CHUNK_IDS)
    count = large.agg(F.sum("n")).first()[0] or 0
    if not count:
        return few
    several = members.join(large.select("kid"), "kid", "left_semi")
    parts = max(1, -(-count // 500_000), min(spark.sparkContext.defaultParallelism, count // 1000))

    def chunks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_kid, held = None, []
        done = [[], [], []]

        def close() -> None:
            for lo in range(0, len(held), CHUNK_IDS):
                for col, v in zip(done, (held_kid, held[lo], ",".join(map(str, held[lo:lo + CHUNK_IDS])))):
                    col.append(v)

        def batch() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.int64()), pa.array(done[2], pa.string())],
                                             ["kid", "low", "ids"])
            for col in done:
                col.clear()
            return got

        for b in it:
            for kid, conv in zip(b.column("kid").to_pylist(), b.column("conv_id").to_pylist()):
                if kid != held_kid or len(held) == CHUNK_IDS:
                    close()
                    held_kid, held = kid, []
                held.append(conv)
            if len(done[0]) >= 500:
                yield batch()
        close()
        yield batch()

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_kid, state = None, None
        for b in it:
            out = [[], []]
            for kid, ids in zip(b.column("kid").to_pylist(), b.column("ids").to_pylist()):
                if kid != held_kid:
                    if state is not None:
                        out[0].append(held_kid)
                        out[1].append(state.digest())
                    held_kid, state = kid, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary())], ["kid", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held_kid]), pa.array([state.digest()], pa.binary())], ["kid", "ends"])

    joined = (several.repartitionByRange(parts, "kid", "conv_id").sortWithinPartitions("kid", "conv_id")
              .mapInArrow(chunks, "kid string, low long, ids string"))
    return few.unionByName(
        joined.repartition(parts, "kid").sortWithinPartitions("kid", "low").mapInArrow(hashed, "kid string, ends binary"))


# -- the operator -------------------------------------------------------------

def words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id long, turns array<struct<id, words>>): every conversation in the order of its turns (null first; equal
    numbers by role, then by turn id).  Null roles and texts are empty.  Rows without conversation id belong to
    none and are left out.  Texts do not move: a turn is its id and its word count."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    told_apart = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    one = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), F.md5(told_apart).alias("id"), words_of(text).alias("words"))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), one.alias("one"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all")).select(
        "conv_id", F.transform("all", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of :func:`sequences` (conv_id long, unique; turns): one row per distinct beginning, the empty one
    included, with conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over its subtree, a node's members but one times the words of its last turn) and ends_sha256 (of the
    members that end there).  Conversations without turns are members of the root; an empty table gives no
    node.  One conversation is one key in one task: 24 bytes a turn."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    words = F.transform("turns", lambda t: t["words"])
    rows = stored(spark, conversations.select("conv_id", key.alias("key"), F.md5(key).alias("kid"), words.alias("words")), "trie-rows")
    keys = rows.groupBy("kid").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"),
                                   F.first("key").alias("key"), F.first("words").alias("words"))
    keys = stored(spark, keys, "trie-keys")
    ends = _digests(spark, rows.select("kid", "conv_id"), keys.select("kid", "n"))
    alone = F.unhex(F.sha2(F.col("conv").cast("string").cast("binary"), 256))
    level = stored(spark, keys.join(ends, "kid", "left").select("key", "words", "n", "conv", F.coalesce("ends", alone).alias("ends")), "trie-level")
    done, whole = _first_level(spark, level)
    found = [done.where("key is null").select(*NODE)]
    while not whole:
        done, whole = _next_level(spark, done.where("key is not null"))
        found.append(done.where("key is null").select(*NODE))
    nodes = reduce(DataFrame.union, found)
    # parents that were finished on a later level; the root may have a large share of all nodes below it
    salt = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt")
    parents = nodes.where("print is not null").select(F.col("print").alias("parent_print"), F.col("conv_id").alias("_parent"), salt)
    waiting = nodes.where("parent_print is not null").withColumn("_salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    late = waiting.join(parents, ["parent_print", "_salt"]).withColumn("parent_conv_id", F.col("_parent"))
    out = nodes.where("parent_print is null").select(*NODE).union(late.select(*NODE))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.lower(F.hex(F.coalesce("ends", F.lit(EMPTY)))).alias("ends_sha256"))
