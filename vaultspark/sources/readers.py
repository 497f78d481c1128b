"""Sources (SR-1..7): raw Parquet directories and validation batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SR-1: scan a Parquet directory glob (e.g. ``.../payment/*/``) with a
    declared schema.  Nothing is inferred; column pruning and predicate
    pushdown happen in the scan."""
    return spark.read.schema(schema).parquet(path)


def register_source(spark: SparkSession, name: str, path: str, schema: T.StructType) -> bool:
    """SR-2: register ``name`` as an external Parquet table only if it does not
    exist yet.  Returns True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")
    return True


# --- validation batches ------------------------------------------------------------

def batch_from_path(spark: SparkSession, path: str, fmt: str = "parquet", **reader_options) -> DataFrame:
    """SR-4: batch from a file path; reader options are passed through."""
    return spark.read.format(fmt).options(**reader_options).load(path)


def batch_from_dataframe(df: DataFrame) -> DataFrame:
    """SR-5: an already loaded DataFrame is the batch."""
    return df


def batch_from_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """SR-6: batch from a catalog table, optionally schema-qualified."""
    return spark.table(f"{schema}.{table}" if schema else table)


def batch_from_query(spark: SparkSession, query: str) -> DataFrame:
    """SR-7: batch from a SQL query."""
    return spark.sql(query)


def limit_batch(df: DataFrame, limit: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """ST-3: optional row limit of a validation batch (off by default).  Which rows stay is defined only with
    ``order_by`` (NULLs last): then each task keeps its own first rows and only those meet."""
    if limit is None:
        return df
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.limit(limit)


def batch_head(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """ST-4: the first rows of a batch, ordered by all columns unless told otherwise."""
    return limit_batch(df, n, order_by or df.columns)
