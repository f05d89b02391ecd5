"""Settings a session needs; the caller owns the session, its master and its memory."""

from pyspark.sql import SparkSession

# Stream state on disk instead of the heap: give these to the builder of a session
# that runs stateful streams (first deliveries, interval join, window fares).
STATEFUL_STREAMS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_zone(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Sets the session's time zone, which fixes the date partitions."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark
