"""Nearest cluster centre in plain column expressions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_point(latitude: str, longitude: str) -> Column:
    """Both coordinates are there and are numbers."""
    present = F.col(latitude).isNotNull() & F.col(longitude).isNotNull()
    return present & ~F.isnan(F.col(latitude).cast("double")) & ~F.isnan(F.col(longitude).cast("double"))


def with_nearest_center(
    df: DataFrame, latitude: str, longitude: str, centers: Sequence[tuple[float, float]], name: str
) -> DataFrame:
    """Adds the index of the closest centre by Euclidean distance in degrees; the first one wins a tie.

    A row whose point is null or not a number gets NULL. The centres become
    literals, so the whole search is compiled into the scan's stage: no vectors
    are built and no function is called per row. The distances are a column of
    their own, so each is worked out once.
    """
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    distances = F.array(
        *[
            (lat - F.lit(c_lat)) * (lat - F.lit(c_lat)) + (lon - F.lit(c_lon)) * (lon - F.lit(c_lon))
            for c_lat, c_lon in centers
        ]
    )
    closest = F.array_position("_distances", F.array_min("_distances")) - 1
    return (
        df.withColumn("_distances", distances)
        .withColumn(name, F.when(is_point(latitude, longitude), closest.cast("int")))
        .drop("_distances")
    )
