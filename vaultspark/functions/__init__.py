"""Column-level building blocks: hash recipe and scalar conversions."""

from vaultspark.functions.hashing import hash_diff, hash_key, normalise, uuid_text
from vaultspark.functions.inet import inet, inet_order, inet_text, ipv6_groups, is_inet, is_ipv4
from vaultspark.functions.scalar import (
    epoch_millis_to_ts,
    epoch_millis_year_slice,
    float_to_int,
    hive_month_start,
    ipv4_to_int,
    ipv4_to_long,
    load_timestamp,
    month_start,
    text_to_int,
    truncating_int,
    ts_to_epoch_millis,
    year_of,
    year_slice,
)

__all__ = [
    "hash_diff", "hash_key", "normalise", "uuid_text",
    "epoch_millis_to_ts", "epoch_millis_year_slice", "float_to_int", "hive_month_start",
    "inet", "inet_order", "inet_text", "ipv4_to_int", "ipv4_to_long", "ipv6_groups", "is_inet", "is_ipv4",
    "load_timestamp",
    "month_start", "text_to_int", "truncating_int", "ts_to_epoch_millis", "year_of", "year_slice",
]
