"""vaultspark: a Spark-native Data Vault warehouse toolkit.

Raw Parquet feeds -> typed, year-partitioned ODS -> staging with hash keys and
hash diffs -> hubs, links, satellites (incremental, repeatable) -> star mart,
plus declarative data-quality suites.  Everything is DataFrame / SQL work that
Catalyst plans and the executors run; the driver only orders the layers.
"""

from vaultspark.session import get_session

__all__ = ["get_session"]
__version__ = "0.1.0"
