"""Looking into the state that a stopped query has kept in its checkpoint."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.regions import Regions, attach_regions
from ridelake.plans.fares import with_average

SUMS = "struct<rides: bigint, fares: bigint, fare_cents: bigint>"


def state_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The query's stateful operators: ``operatorId``, ``operatorName``, ``stateStoreName``, ``numPartitions``, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """``key``, ``value`` and ``partition_id`` of all rows that an operator holds after a batch, by default the last."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def pending_windows(spark: SparkSession, checkpoint: str, regions: Regions) -> DataFrame:
    """The windows that a ``window_fares`` query has not closed yet, with the rides so far, in the columns it will give them.

    Reads state files only, in as many tasks as the state has partitions. Give the regions of the query.
    """
    place = "pickup_cluster: int" if regions.separate else "pickup_region: string"
    # The state's own names are not unique; its columns lie in the order of the grouping and its sums.
    key = F.col("key").cast(f"struct<window: struct<start: timestamp, end: timestamp>, {place}>")
    held = state_rows(spark, checkpoint).select(key.alias("key"), F.col("value").cast(SUMS).alias("sums"))
    rows = held.select("key.*", "sums.*")
    found = with_average(attach_regions(rows, regions) if regions.separate else rows)
    times = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return found.select(*times, "pickup_region", "rides", "fare_cents", "avg_fare")
