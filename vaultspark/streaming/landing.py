"""Incremental trigger over a landing folder.

The reference's raw feeds are folders that receive new yearly sub-folders,
read as external tables, and a yearly schedule reloads the year.  With
Structured Streaming the arrival of files is the trigger: a file-source
stream over the feed (declared schema, no inference) hands each micro-batch
to ``foreachBatch``, which finds the batch years the new files touch (one
small aggregate: at most one row per year) and runs the same yearly load as
the batch pipeline for each, oldest first.  The stream's checkpoint lives in
the shared checkpoint folder, so a restarted driver resumes after the last
committed batch; the loads themselves are partition overwrites and
anti-joined appends, so a replayed batch does not duplicate hubs or links.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vaultspark.functions.scalar import epoch_millis_to_ts
from vaultspark.sources.schemas import ODS_DATE_COLUMN, STG


def touched_years(batch: DataFrame, source: str) -> list[int]:
    """Distinct batch years of the rows in ``batch`` (at most one per year)."""
    col = F.col(ODS_DATE_COLUMN[source])
    if source == "traffic":
        col = epoch_millis_to_ts(col)
    years = batch.select(F.year(col).alias("y")).where("y is not null").distinct()
    return sorted(r.y for r in years.collect())


def watch_feed(spark: SparkSession, source: str, path: str, on_year: Callable[[int], None],
               checkpoint: str, schema: T.StructType | None = None,
               available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream over ``path`` that calls ``on_year(year)`` for every year
    touched by newly arrived files (e.g. ``lambda y: run_year(spark, wh, feeds, y)``)."""
    reader = spark.readStream.schema(schema or STG[source])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        for y in touched_years(batch, source):
            on_year(y)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
