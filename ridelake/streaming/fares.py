"""Fares by time window and region, near real time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.operators.regions import Regions, assign_cluster, attach_regions
from ridelake.plans.fares import fare_sums, with_average
from ridelake.streaming.landing import with_lateness


def window_sums(rides: DataFrame, regions: Regions, width: str = "1 hour", *more: Column) -> DataFrame:
    """Rides, fare cents, average fare and ``more`` counts per window and region, of a batch or a stream with a watermark.

    A ride without a time is in no window. Where no region lies in two clusters rides are summed per window and
    cluster, and regions are attached to the finished windows only.
    """
    clustered = assign_cluster(rides, regions.model, "keep")
    window = F.window("pickup_datetime", width).alias("window")
    sums = [*fare_sums(), *more]
    if regions.separate:
        found = attach_regions(clustered.groupBy(window, "pickup_cluster").agg(*sums), regions)
    else:
        found = attach_regions(clustered, regions).groupBy(window, "pickup_region").agg(*sums)
    first = {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    found = with_average(found).withColumns(first).drop("window")
    names = ["pickup_region", "rides", "fare_cents", "avg_fare"]
    return found.select(*first, *names, *[name for name in found.columns if name not in {*first, *names}])


def window_fares(rides: DataFrame, regions: Regions, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rides, fare cents and average fare per window and region; a window comes out once it is closed.

    Rides of a window that is closed are dropped; ``streaming.late`` keeps them. The state holds one row per window and
    cluster where no region lies in two clusters.
    """
    return window_sums(with_lateness(rides, delay), regions, width)
