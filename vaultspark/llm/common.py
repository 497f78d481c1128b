"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.sources.fixtures import table
from vaultspark.sources.sinks import shared_root

__all__ = ["table", "scratch", "stored", "let", "texts", "numbered", "distinct_names", "crc_mod"]

#: ASCII white space that separates words (fixed by the contracts).
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of the cluster."""
    return shared_root(spark, f"llm-{name}")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage
    at files every executor can read again."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable,
    so the optimizer cannot copy it into inner lambdas)."""
    return F.transform(F.array(value), body)[0]


def crc_mod(c: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: 0 is crc32 of '')."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))) % n


def distinct_names(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under the operators' own names; whatever else
    the table holds cannot clash with internal columns."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def small_batches(it: Iterator[pa.RecordBatch], col: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most about ``limit`` bytes of ``col`` (one
    row at least), so that work space does not follow the batch size."""
    for b in it:
        if b.num_rows == 0:
            continue
        size = np.cumsum(np.array([len(x) for x in texts(b.column(col))], dtype=np.int64) + 1)
        start = 0
        while start < b.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield b.slice(start, stop - start)
            start = stop


def numbered(spark: SparkSession, df: DataFrame, group: list[str], spread: list[str], weight: Column | None = None,
             out: str = "number", per_task: int = 50_000, rows: int | None = None, salt: list[str] | None = None) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, or give the sum of
    ``weight`` of the rows before each.

    A group of any size is dealt to buckets by a hash of ``spread`` (columns
    that tell rows apart): bucket totals are pre-aggregated, prefixed per
    group, and only then is each bucket ordered.  No task holds a group.
    ``df`` must be a stored table (it is read twice).  ``salt`` names the columns
    that are hashed if they are not ``spread``."""
    rows = df.count() if rows is None else rows
    buckets = max(1, -(-rows // per_task))
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    with_b = df.withColumn("_b", F.pmod(F.xxhash64(*[F.col(c) for c in salt or spread]), F.lit(buckets))).withColumn("_w", w)
    totals = with_b.groupBy(*group, "_b").agg(F.sum("_w").alias("_t"))
    # the totals of a group are at most ``buckets`` rows; with many buckets they are prefixed in two steps
    from pyspark.sql import Window as W

    span = max(1, int(buckets ** 0.5))
    coarse = F.floor(F.col("_b") / span)
    upper = totals.groupBy(*group, coarse.alias("_c")).agg(F.sum("_t").alias("_ct"))
    upper = upper.withColumn("_cb", F.sum("_ct").over(
        W.partitionBy(*(group or [F.lit(0)])).orderBy("_c").rowsBetween(W.unboundedPreceding, -1)))
    lower = totals.withColumn("_c", coarse).withColumn("_tb", F.sum("_t").over(
        W.partitionBy(*group, "_c").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)))
    base = (_null_safe(lower, upper.drop("_ct"), [*group, "_c"])
            .select(*group, "_b", (F.coalesce("_cb", F.lit(0)) + F.coalesce("_tb", F.lit(0))).alias("_base")))
    inside = F.sum("_w").over(W.partitionBy(*group, "_b").orderBy(*spread).rowsBetween(W.unboundedPreceding, -1))
    ranked = with_b.withColumn("_in", F.coalesce(inside, F.lit(0)))
    return (_null_safe(ranked, base, [*group, "_b"])
            .withColumn(out, F.col("_in") + F.col("_base")).drop("_b", "_w", "_in", "_base"))


def _null_safe(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on columns that are never null here."""
    return a.join(b, on)

