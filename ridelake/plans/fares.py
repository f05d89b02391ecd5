"""Fares by time and place."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.columns import cents
from ridelake.operators.regions import Regions, assign_cluster, attach_regions
from ridelake.plans.curation import clustered_rides, curated

_SUMS = ["rides", "fares", "fare_cents"]


def fare_sums() -> list[Column]:
    """Rides, rides with a fare, and fares in whole cents."""
    return [
        F.count("*").alias("rides"),
        F.count("fare_amount").alias("fares"),
        F.sum(cents("fare_amount")).alias("fare_cents"),
    ]


def with_average(sums: DataFrame) -> DataFrame:
    """Replaces the helper count by the average fare; NULL where no ride has a fare."""
    average = F.try_divide(F.col("fare_cents").cast("double"), F.col("fares")) / 100
    return sums.withColumn("avg_fare", average).drop("fares")


def fares_by_day(rides: DataFrame) -> DataFrame:
    """Rides, fare cents and average fare per pickup day."""
    return with_average(rides.groupBy(F.to_date("pickup_datetime").alias("pickup_day")).agg(*fare_sums()))


def fares_by_day_region(rows: DataFrame) -> DataFrame:
    """The same per day and region of the curated table.

    A ride counts once in every region of its cluster: do not add regions up.
    """
    groups = rows.groupBy(F.to_date("pickup_datetime").alias("pickup_day"), "pickup_region")
    return with_average(groups.agg(*fare_sums()))


def _by_day_and_region(clustered: DataFrame, regions: Regions) -> DataFrame:
    """Sums per day and cluster, made in the map tasks, and only then the regions of the cluster."""
    per_cluster = clustered.groupBy(F.to_date("pickup_datetime").alias("pickup_day"), "pickup_cluster").agg(*fare_sums())
    per_region = attach_regions(per_cluster, regions)
    if not regions.separate:
        per_region = per_region.groupBy("pickup_day", "pickup_region").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return with_average(per_region)


def fares_by_day_region_of(rides: DataFrame, regions: Regions) -> DataFrame:
    """The same straight from rides with coordinates, without building the curated rows.

    Rides are summed per day and cluster first, in the map tasks, so the fan-out to
    regions works on a few rows per day instead of on every ride.
    """
    return _by_day_and_region(assign_cluster(rides, regions.model, "keep"), regions)


def fares_of_raw(raw: DataFrame, regions: Regions) -> DataFrame:
    """``fares_by_day_region`` of the rides that curation would keep, summed before their fan-out.

    Rides are made distinct first, as in the curated table. Where two clusters share a region, only
    the curated rows themselves tell what is counted once.
    """
    if not regions.separate:
        return fares_by_day_region(curated(raw, regions))
    return _by_day_and_region(clustered_rides(raw, regions), regions)
