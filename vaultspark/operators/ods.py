"""Typed loads raw feed -> ODS (PR-1..5, FL-1..2, SR-3).

Each loader is ``(raw DataFrame, year) -> typed DataFrame``.  The year slice is
applied to the raw column as a half-open range *before* the projection, so a
Parquet scan receives it as a pushed filter; the projection is one codegen'd
``Project``.  ``year=None`` loads every row (used for full loads and the
partition-label routing of SK-1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspark.functions.scalar import (
    epoch_millis_to_ts,
    epoch_millis_year_slice,
    float_to_int,
    hive_month_start,
    inet,
    ipv4_to_int,
    month_start,
    text_to_int,
    truncating_int,
    year_slice,
)
from vaultspark.sources.schemas import ODS_DATE_COLUMN
from vaultspark.sources.sinks import partition_label


def _slice(df: DataFrame, cond) -> DataFrame:
    return df if cond is None else df.where(cond)


# --- PostgreSQL/Greenplum dialect (PR-1..4) -------------------------------------------

def ods_billing(stg: DataFrame, year: int | None = None, strict: bool = True) -> DataFrame:
    """PR-1: billing period 'YYYY-MM' -> first of month, text sum -> INT."""
    df = _slice(stg, None if year is None else year_slice("created_at", year, "date"))
    return df.select(
        F.col("user_id").cast("int").alias("user_id"),
        month_start("billing_period", strict).alias("billing_period"),
        F.col("service"),
        F.col("tariff"),
        text_to_int("sum", strict).alias("sum"),
        F.col("created_at").cast("date").alias("created_at"),
    )


def ods_issue(stg: DataFrame, year: int | None = None, strict: bool = True) -> DataFrame:
    """PR-2: text user id -> INT."""
    df = _slice(stg, None if year is None else year_slice("start_time", year, "timestamp"))
    return df.select(
        text_to_int("user_id", strict).alias("user_id"),
        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        F.col("end_time").cast("timestamp_ntz").alias("end_time"),
        F.col("title"),
        F.col("description"),
        F.col("service"),
    )


def ods_payment(stg: DataFrame, year: int | None = None, strict: bool = True) -> DataFrame:
    """PR-3: billing period -> DATE, float sum -> INT rounding half to even."""
    df = _slice(stg, None if year is None else year_slice("pay_date", year, "date"))
    return df.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("pay_doc_type"),
        F.col("pay_doc_num").cast("int").alias("pay_doc_num"),
        F.col("account"),
        F.col("phone").cast("decimal(11,0)").alias("phone"),
        month_start("billing_period", strict).alias("billing_period"),
        F.col("pay_date").cast("date").alias("pay_date"),
        float_to_int("sum").alias("sum"),
    )


def ods_traffic(stg: DataFrame, year: int | None = None, on_invalid_ip: str = "raise") -> DataFrame:
    """PR-4: epoch ms -> TIMESTAMP (fraction kept), IP validated, counters BIGINT."""
    df = _slice(stg, None if year is None else epoch_millis_year_slice("timestamp", year))
    return df.select(
        F.col("user_id").cast("int").alias("user_id"),
        epoch_millis_to_ts("timestamp").alias("timestamp"),
        F.col("device_id"),
        inet("device_ip_addr", on_invalid_ip).alias("device_ip_addr"),
        F.col("bytes_sent").cast("bigint").alias("bytes_sent"),
        F.col("bytes_received").cast("bigint").alias("bytes_received"),
    )


def ods_user(mdm: DataFrame) -> DataFrame:
    """SR-3: MDM snapshot: ``id -> user_id``, ``registered_at::DATE``."""
    return mdm.select(
        F.col("id").cast("int").alias("user_id"),
        F.col("legal_type"),
        F.col("district"),
        F.col("registered_at").cast("date").alias("registered_at"),
        F.col("billing_mode"),
        F.col("is_vip").cast("boolean").alias("is_vip"),
    )


ODS_LOADERS = {"billing": ods_billing, "issue": ods_issue, "payment": ods_payment,
               "traffic": ods_traffic}


# --- Hive dialect (PR-5) ------------------------------------------------------------------

def ods_billing_hive(stg: DataFrame, year: int | None = None) -> DataFrame:
    df = _slice(stg, None if year is None else year_slice("created_at", year, "date"))
    return df.select(
        truncating_int("user_id").alias("user_id"),
        hive_month_start("billing_period").alias("billing_period"),
        F.col("service"),
        F.col("tariff"),
        truncating_int("sum").alias("sum"),
        F.col("created_at").try_cast("date").alias("created_at"),
    )


def ods_issue_hive(stg: DataFrame, year: int | None = None) -> DataFrame:
    df = _slice(stg, None if year is None else year_slice("start_time", year, "timestamp"))
    return df.select(
        truncating_int("user_id").alias("user_id"),
        F.col("start_time").try_cast("timestamp_ntz").alias("start_time"),
        F.col("end_time").try_cast("timestamp_ntz").alias("end_time"),
        F.col("title"),
        F.col("description"),
        F.col("service"),
    )


def ods_payment_hive(stg: DataFrame, year: int | None = None) -> DataFrame:
    df = _slice(stg, None if year is None else year_slice("pay_date", year, "date"))
    return df.select(
        truncating_int("user_id").alias("user_id"),
        F.col("pay_doc_type"),
        truncating_int("pay_doc_num").alias("pay_doc_num"),
        F.col("account"),
        F.col("phone").try_cast("decimal(11,0)").alias("phone"),
        hive_month_start("billing_period").alias("billing_period"),
        F.col("pay_date").try_cast("date").alias("pay_date"),
        truncating_int("sum").alias("sum"),
    )


def ods_traffic_hive(stg: DataFrame, year: int | None = None) -> DataFrame:
    """IPv4 packed into a signed 32-bit INT, as the Hive load does (SC-9)."""
    df = _slice(stg, None if year is None else epoch_millis_year_slice("timestamp", year))
    return df.select(
        truncating_int("user_id").alias("user_id"),
        epoch_millis_to_ts(F.col("timestamp").try_cast("bigint")).alias("timestamp"),
        F.col("device_id"),
        ipv4_to_int("device_ip_addr").alias("device_ip_addr"),
        F.col("bytes_sent").try_cast("bigint").alias("bytes_sent"),
        F.col("bytes_received").try_cast("bigint").alias("bytes_received"),
    )


HIVE_LOADERS = {"billing": ods_billing_hive, "issue": ods_issue_hive,
                "payment": ods_payment_hive, "traffic": ods_traffic_hive}


# --- partition routing (SK-1) -----------------------------------------------------------

def with_partition_label(ods: DataFrame, source: str) -> DataFrame:
    """Add the range-partition label of the source's date column."""
    from vaultspark.sources.sinks import PARTITION_COLUMN

    return ods.withColumn(PARTITION_COLUMN, partition_label(ODS_DATE_COLUMN[source]))
