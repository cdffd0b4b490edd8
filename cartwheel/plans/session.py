"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

REQUIRED = {
    # zone-less event times are read as UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime plan changes: small joins, skewed joins, partition sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on; sizes and parallelism stay with the cluster."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """State beyond memory goes to local disk and the checkpoint folder; sessions merge before the shuffle too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return prepare(spark)
