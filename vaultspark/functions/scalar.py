"""Scalar conversions of the typed loads (SC-1..10, SC-13..18).

Every helper is a Column expression built from Spark built-ins, so it stays in
codegen and runs on the executors.  None depends on the session time zone:
timestamps are TIMESTAMP_NTZ throughout, epoch values are converted with
``timestamp_add`` / ``timestampdiff`` against a zone-free epoch literal.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultspark.functions.inet import inet, inet_text, is_ipv4  # noqa: F401

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# --- numbers ---------------------------------------------------------------

def text_to_int(c: Column | str, strict: bool = True) -> Column:
    """``x::INT`` from text (SC-1): strict raises on '12.5' / 'x' (ANSI cast),
    tolerant gives NULL."""
    c = _col(c)
    return c.cast("int") if strict else c.try_cast("int")


def float_to_int(c: Column | str) -> Column:
    """``x::INT`` from a float, rounding half to even like PostgreSQL (SC-2)."""
    return F.rint(_col(c)).cast("int")


def truncating_int(c: Column | str, target: str = "int") -> Column:
    """Hive-style cast (SC-4): fraction truncated, bad value -> NULL.

    Text goes through a decimal first because ``try_cast('12.5' as int)`` is
    NULL in Spark while Hive gives 12.
    """
    c = _col(c)
    return c.try_cast("decimal(38,9)").try_cast(target)


# --- dates and timestamps ------------------------------------------------------

def month_start(c: Column | str, strict: bool = True) -> Column:
    """``TO_DATE(p, 'YYYY-MM')`` -> first day of the month (SC-5)."""
    c = _col(c)
    return F.to_date(c, "yyyy-MM") if strict else F.try_to_date(c, "yyyy-MM")


def hive_month_start(c: Column | str) -> Column:
    """``cast(concat(p, '-01') as date)``; a bad period gives NULL (SC-6)."""
    return F.concat(_col(c), F.lit("-01")).try_cast("date")


def epoch_millis_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ, fraction kept (SC-7)."""
    return F.timestamp_add("MILLISECOND", _col(c), epoch_ntz())


def ts_to_epoch_millis(c: Column | str) -> Column:
    """TIMESTAMP_NTZ -> epoch milliseconds (truncating), zone-free."""
    micros = F.timestamp_diff("MICROSECOND", epoch_ntz(), _col(c).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(1000)).cast("bigint")


def year_of(c: Column | str) -> Column:
    """``EXTRACT(YEAR FROM c)`` as INT (SC-10)."""
    return F.year(_col(c))


def _bound(year: int, kind: str) -> Column:
    if kind == "date":
        return F.lit(f"{year:04d}-01-01").cast("date")
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def year_slice(c: Column | str, year: int, kind: str = "date") -> Column:
    """``EXTRACT(YEAR FROM c) = year`` written as a half-open range (FL-1).

    Equal to the year predicate for DATE and TIMESTAMP columns, but a range on
    the bare column is pushed down to the Parquet scan (row-group statistics),
    the function form is not.
    """
    c = _col(c)
    return (c >= _bound(year, kind)) & (c < _bound(year + 1, kind))


def year_range(c: Column | str, first: int, last: int, kind: str = "date") -> Column:
    """``first <= EXTRACT(YEAR FROM c) <= last`` as a pushable half-open range."""
    c = _col(c)
    return (c >= _bound(first, kind)) & (c < _bound(last + 1, kind))


def epoch_millis_of_year(year: int) -> int:
    return calendar.timegm(dt.datetime(year, 1, 1).timetuple()) * 1000


def epoch_millis_year_slice(c: Column | str, year: int) -> Column:
    """Year slice over epoch milliseconds as a BIGINT range (FL-2), pushable."""
    c = _col(c)
    return (c >= F.lit(epoch_millis_of_year(year))) & (c < F.lit(epoch_millis_of_year(year + 1)))


def load_timestamp(value: dt.datetime | dt.date | str) -> Column:
    """Batch load date literal as TIMESTAMP_NTZ (PR-7)."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


# --- IP addresses --------------------------------------------------------------

def _octets_sum(c: Column) -> Column:
    parts = F.split(c, r"[.]")
    total = None
    for i, shift in enumerate((24, 16, 8, 0)):
        octet = F.get(parts, i).try_cast("int").cast("bigint")
        term = F.shiftleft(octet, shift) if shift else octet
        total = term if total is None else total + term
    return total


def ipv4_to_long(c: Column | str) -> Column:
    """IPv4 text -> unsigned value as BIGINT (192.168.1.7 -> 3232235783)."""
    return _octets_sum(_col(c))


def ipv4_to_int(c: Column | str) -> Column:
    """IPv4 text -> 32-bit signed INT as the Hive load computes it (SC-9):
    ``shiftleft(o1,24)+shiftleft(o2,16)+shiftleft(o3,8)+o4`` with int wrap-around,
    so 192.168.1.7 -> -1062731513.  A missing or bad octet gives NULL."""
    v = _octets_sum(_col(c))
    two32 = F.lit(1 << 32)
    wrapped = F.pmod(v, two32)
    return F.when(wrapped >= F.lit(1 << 31), wrapped - two32).otherwise(wrapped).cast("int")
