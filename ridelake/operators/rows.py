"""Row-level operators: coordinate filter, parts, distinct."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_coordinates(rides: DataFrame) -> DataFrame:
    """Rides that have both pickup coordinates; the test is pushed into the scan."""
    return rides.filter(F.col("pickup_latitude").isNotNull() & F.col("pickup_longitude").isNotNull())


def random_parts(df: DataFrame, parts: int = 10, seed: int | None = None) -> list[DataFrame]:
    """``parts`` disjoint random frames of about equal size that together hold every row.

    Each frame scans ``df`` again; to write all parts use ``with_part`` and one write.
    """
    return df.randomSplit([1.0] * parts, seed)


def with_part(df: DataFrame, parts: int = 10, by: Column | None = None) -> DataFrame:
    """Adds ``part``, a number in ``[0, parts)`` fixed by ``by`` (an integer column, default a key hash)."""
    number = F.xxhash64("key") if by is None else by
    return df.withColumn("part", F.pmod(number, F.lit(parts)).cast("int"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates dropped over all columns; copies collapse in the map tasks, before the shuffle."""
    return df.dropDuplicates()
