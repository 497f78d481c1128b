"""Sources (raw feeds, validation batches), sinks and declared schemas."""

from vaultspark.sources import fixtures, readers, schemas, sinks
from vaultspark.sources.sinks import Warehouse, partition_label, shared_root

__all__ = ["fixtures", "readers", "schemas", "sinks", "Warehouse", "partition_label", "shared_root"]
