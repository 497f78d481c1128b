"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.io.compression.codec": "zstd",  # hash keys in hex: lz4 leaves them as long as they are
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vaultspark", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.  Settings given
    by the cluster win over the defaults; explicit arguments win over both."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
