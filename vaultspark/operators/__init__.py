"""Operators: typed loads, staging, vault loaders, marts, data quality."""

from vaultspark.operators import marts, ods, quality, staging, vault

__all__ = ["marts", "ods", "quality", "staging", "vault"]
