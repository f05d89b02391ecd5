"""Rides and neighbourhoods in the lake's shape, derived from the given ``events`` and ``nation`` tables.

The numbers are fixed values of the test fixture. They give every ride a pickup and
a drop-off in a city-sized box and inject missing, out-of-range and unreadable values.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.events import to_events
from ridelake.schemas import COORDINATE, RIDES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rides(spark: SparkSession, sf_dir: str, key: str, *more: Column) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    no_longitude = F.lit(None).cast("double")
    return _table(spark, sf_dir, "events").select(
        F.col(key).cast("string").alias("key"),
        F.col("value").alias("fare_amount"),
        F.col("ts").cast("timestamp").alias("pickup_datetime"),
        F.when(event % 50 == 0, no_longitude).otherwise(-74.23 + 0.0071 * (event % 53)).alias("pickup_longitude"),
        (40.48 + 0.0037 * (user % 47)).alias("pickup_latitude"),
        F.when(event % 61 == 0, F.lit(-173.5)).otherwise(-74.21 + 0.0071 * (user % 53)).alias("dropoff_longitude"),
        (40.49 + 0.0037 * (event % 47)).alias("dropoff_latitude"),
        F.when(event % 83 == 0, 208).otherwise(event % 6 + 1).cast("int").alias("passenger_count"),
        *more,
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ride per event, over the whole table."""
    return _rides(spark, sf_dir, "event_id")


def rides_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rides keyed by user, so that keys repeat; ``ride`` tells them apart."""
    return _rides(spark, sf_dir, "user_id", F.col("event_id").cast("string").alias("ride"))


def untimed(df: DataFrame, ride: str) -> DataFrame:
    """The rides, of which every seventy-first has no pickup time."""
    gone = F.col(ride).cast("bigint") % 71 == 0
    return df.withColumn("pickup_datetime", F.when(~gone, F.col("pickup_datetime")))


def closing_ride(df: DataFrame) -> DataFrame:
    """One more ride, a day after the last: once a stream has seen it, all others are settled. Its key is ``closing``."""
    last = df.agg((F.max("pickup_datetime") + F.expr("INTERVAL 1 DAY")).alias("pickup_datetime"))
    numbers = {f.name: F.lit(0).cast(f.dataType) for f in RIDES.fields if f.name not in ("key", "pickup_datetime")}
    return last.withColumns({"key": F.lit("closing"), **numbers}).select(*RIDES.names)


def with_new_fields(df: DataFrame) -> DataFrame:
    """Rides of which every third has a surge and a tip; a tip is a number, or at times a word."""
    number = F.col("key").cast("bigint")
    tip = F.when(number % 9 == 0, F.lit("none").cast("variant")).otherwise((number % 5).cast("variant"))
    surge = 1 + 0.25 * (number % 7)
    return df.withColumns({name: F.when(number % 3 == 0, value) for name, value in {"surge": surge, "tip": tip}.items()})


def broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ride as an event; the text of some is cut to an unreadable stub."""
    stub = F.when(F.col("key").cast("bigint") % 97 == 0, "{bad").otherwise(F.col("value"))
    return to_events(rides(spark, sf_dir)).withColumn("value", stub)


def delivered_twice(df: DataFrame) -> DataFrame:
    """All rows, with every twentieth key delivered a second time."""
    return df.unionAll(df.filter(F.col("key").cast("bigint") % 20 == 0))


def neighborhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One neighbourhood per nation, in twelve groups that lie well apart."""
    group, layer = F.col("n_nationkey") % 12, F.floor(F.col("n_nationkey") / 12)
    latitude = F.lit(40.50) + 0.05 * F.floor(group / 4) + 0.001 * layer
    longitude = F.lit(-74.20) + 0.10 * (group % 4) + 0.0013 * layer
    return _table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("neighborhood"),
        latitude.cast(COORDINATE).alias("latitude"),
        longitude.cast(COORDINATE).alias("longitude"),
    )
