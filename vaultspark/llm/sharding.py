"""Sharding by longest-processing-time scheduling.

Rows with equal keys stay together.  Groups are taken in order of falling size and
each goes to the shard with the least load, kept in a heap.

Scale: the schedule runs over size classes, not over groups.  Sizes below 2^12 are
classes of their own; larger ones share a class with sizes that agree in their first
12 bits (within 0.025 %), so there are at most 2^12 * 52 classes of 64-bit sizes.
The driver sees one row per class (number of groups, their bytes).  A class of many groups is
dealt at once: every shard gets what lifts it to the common level, the last few
groups go through the heap.  Each class' groups are numbered in order of falling size in
salted buckets, and a group's number finds its shard in the class' quotas.  Rows are numbered in their
shard by prefixed bucket totals.  No task holds a class, a shard or a group of copies.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import numbered, stored

#: Bits of a size that its class keeps.
CLASS_BITS = 12
#: Groups of one class that go through the heap one by one.
HEAP_GROUPS = 8


def size_class(size: Column) -> Column:
    """The size with all but its first ``CLASS_BITS`` bits cleared (lowest size of its class)."""
    bits = F.length(F.bin(size))
    drop = F.greatest(bits - F.lit(CLASS_BITS), F.lit(0))
    return F.when(drop > 0, F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)).otherwise(size)


def schedule(classes: Iterable[tuple[int, int, int]], shards: int) -> dict[int, list[int]]:
    """Groups of each class per shard: ``classes`` holds (class, groups, their bytes)."""
    loads = np.zeros(shards)
    quota: dict[int, list[int]] = {}
    for name, groups, size in sorted(classes, key=lambda c: (-c[2] / c[1], -c[0])):
        mean, mine = size / groups, np.zeros(shards, dtype=np.int64)
        bulk = groups - HEAP_GROUPS * shards
        if bulk > 0:
            # lift the lowest shards to one level with ``bulk`` groups of the mean size
            order = np.argsort(loads, kind="stable")
            rising = loads[order]
            need = rising * np.arange(1, shards + 1) - np.cumsum(rising)  # to lift the first k to the k-th
            k = int(np.searchsorted(need, bulk * mean, side="right"))
            level = (bulk * mean + rising[:k].sum()) / k
            mine[order[:k]] = np.floor((level - rising[:k]) / mean + 1e-9).astype(np.int64)
            mine = np.maximum(mine, 0)
            while mine.sum() > bulk:  # by rounding of floats only
                mine[int(np.argmax(mine))] -= 1
        heap = [(loads[s] + mine[s] * mean, s) for s in range(shards)]
        heapq.heapify(heap)
        for _ in range(groups - int(mine.sum())):
            load, s = heap[0]
            mine[s] += 1
            heapq.heapreplace(heap, (load + mean, s))
        loads += mine * mean
        quota[name] = mine.tolist()
    return quota


def _turns(quota: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Shard of each rank: shards take turns (largest groups first) until their quota is used up,
    so that sizes inside a class are spread evenly too."""
    levels = np.unique(quota[quota > 0])
    start, before, base = [], 0, []
    rounds = 0
    for lv in levels:
        open_ = int((quota >= lv).sum())
        start.append(before)
        base.append(rounds)
        before += open_ * (int(lv) - rounds)
        rounds = int(lv)
    at = np.searchsorted(np.array(start), ranks, side="right") - 1
    out = np.empty(len(ranks), dtype=np.int32)
    for i, lv in enumerate(levels):
        here = np.flatnonzero(at == i)
        if len(here):
            names = np.flatnonzero(quota >= lv)
            turn, place = np.divmod(ranks[here] - start[i], len(names))
            out[here] = names[np.where((turn + base[i]) % 2 == 0, place, len(names) - 1 - place)]
    return out


def assign(spark: SparkSession, rows: DataFrame, key: str = "key", size: str = "size", unique: tuple[str, ...] = ("row",),
           shards: int = 16) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (numbered in each shard from 0 without gaps).

    ``key`` names the column whose equal values stay together, ``size`` a row's
    non-negative size, ``unique`` columns that tell rows apart.  A null key is a group, a
    null size is 0.  ``rows`` must be a stored table with these columns; its other columns
    must not be called shard or slot.  An empty table gives an empty result."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    groups = rows.groupBy(F.col(key).alias("g")).agg(F.sum(F.coalesce(F.col(size).cast("long"), F.lit(0))).alias("bytes"))
    groups = stored(spark, groups.withColumn("cls", size_class(F.col("bytes"))), "groups")
    classes = [(r["cls"], r["n"], r["b"]) for r in groups.groupBy("cls").agg(F.count("*").alias("n"), F.sum("bytes").alias("b")).collect()]
    quota = schedule([(c, n, max(b, 1)) for c, n, b in classes], shards)
    table = np.array([quota[c] for c in sorted(quota)], dtype=np.int64).reshape(-1, shards)
    names = np.array(sorted(quota), dtype=np.int64)
    ranked = numbered(spark, groups.withColumn("neg", -F.col("bytes")), ["cls"], ["neg", "g"], out="rank",
                      rows=sum(n for _, n, _ in classes), salt=["g"])

    def place(it):
        for b in it:
            cls, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "rank"))
            out = np.zeros(len(cls), dtype=np.int32)
            for one in np.unique(cls):
                mine = np.flatnonzero(cls == one)
                out[mine] = _turns(table[np.searchsorted(names, one)], rank[mine])
            yield pa.RecordBatch.from_arrays([b.column("g"), pa.array(out)], ["_g", "shard"])

    kind = groups.schema["g"].dataType.simpleString()
    where = stored(spark, ranked.mapInArrow(place, f"_g {kind}, shard int"), "group-shards")
    dealt = stored(spark, rows.join(where, F.col(key).eqNullSafe(F.col("_g"))).drop("_g"), "dealt")
    return numbered(spark, dealt, ["shard"], list(unique), out="slot", rows=dealt.count())


def document_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, key, size, text_crc32): what sharding needs to know of each document.  Equal texts
    have equal keys; a null text has size 1 and the empty text's key."""
    text = F.col(f"`{text_col}`").cast("string")
    body = F.coalesce(text, F.lit(""))
    key = F.sha2(body, 256)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), key.alias("key"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32")).withColumn("row", F.xxhash64("doc_id", "key"))


def shard_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): documents with equal texts in one shard, bytes near
    equal.  Repeated rows are rows of their own; a null id is kept; other columns are not read."""
    rows = stored(spark, document_rows(docs, id_col, text_col), "rows")
    out = assign(spark, rows, "key", "size", ("row", "doc_id", "key"), shards)
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 shards: int = 16, files_per_shard: int = 1) -> None:
    """Write ``docs`` to ``path``/shard=N with all their columns.  Each shard is dealt to ``files_per_shard`` files by slot."""
    rows = stored(spark, document_rows(docs, id_col, text_col), "rows")
    where = assign(spark, rows, "key", "size", ("row", "doc_id", "key"), shards).select(F.col("row").alias("_row"), "shard").distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    tagged = docs.withColumn("_own", F.xxhash64(F.col(f"`{id_col}`"), F.sha2(text, 256)))
    out = tagged.join(where, F.col("_own") == F.col("_row")).drop("_own", "_row")
    out.repartition(shards * files_per_shard, "shard", F.pmod(F.xxhash64(f"`{id_col}`"), F.lit(files_per_shard))).write.partitionBy("shard").parquet(path)
