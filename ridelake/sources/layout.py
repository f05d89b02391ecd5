"""Raw tables laid out by time and place within each day, so that a box of both reads few row groups.

Partitions by date cannot skip anything within a day. Here rides of a day follow a space-filling curve over their time of day, latitude
and longitude: what lies close together in all three lies in the same files and row groups, whose least
and largest values then rule most of them out. Keys get Parquet bloom filters, as they follow no order at all.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.schemas import DATE_PARTS
from ridelake.sources.lake import in_date_range

# Cells along each axis: 2 ** BITS. All three axes make a number of 3 * BITS bits.
BITS = 12
ROW_GROUP_BYTES = 16 << 20
DAY = 86_400_000_000
BOX = ("pickup_latitude", "pickup_longitude")


def _cell(value: Column, low: float, high: float) -> Column:
    """Which of the cells between ``low`` and ``high`` a value is in; values beyond are in the outermost, none in the first."""
    share = (value.cast("double") - F.lit(float(low))) / F.lit(float(high - low) or 1.0)
    inside = F.when(F.isnan(share) | (share < 0), 0.0).when(share > 1, 1.0).otherwise(share)
    return F.coalesce(F.least(F.floor(inside * 2**BITS), F.lit(2**BITS - 1)), F.lit(0)).cast("bigint")


def curve_number(cells: list[Column]) -> Column:
    """The place on the curve: the bits of all cells in turn, the highest first."""
    number = F.lit(0).cast("bigint")
    for bit in range(BITS):
        for axis, cell in enumerate(cells):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1))
            number = number.bitwiseOR(F.shiftleft(one, bit * len(cells) + axis))
    return number


def append_by_place(
    rides: DataFrame,
    path: str,
    time: str = "pickup_datetime",
    row_group_bytes: int = ROW_GROUP_BYTES,
    keys_in_a_file: int | None = None,
) -> None:
    """Appends raw rides, partitioned by date and ordered along the curve within it.

    One range partitioning over date and curve: a hot day is cut into as many ranges as it needs, however
    few places its rides have (rides of one cell are told apart by their keys). The bounds of the places are
    measured first, over the rides that have them; ``keys_in_a_file`` is what the bloom filters reckon with.
    """
    limits = [f(c).alias(f"{f.__name__}_{c}") for c in BOX for f in (F.min, F.max)]
    measured = rides.filter(~F.isnan(BOX[0]) & ~F.isnan(BOX[1])).agg(*limits).first()
    bounds = [(measured[f"min_{c}"] or 0.0, measured[f"max_{c}"] or 0.0) for c in BOX]
    cells = [_cell(F.pmod(F.unix_micros(time), F.lit(DAY)), 0, DAY)]
    cells += [_cell(F.col(c), *bound) for c, bound in zip(BOX, bounds)]
    ranges = [*DATE_PARTS, "_curve", "key"]
    laid = rides.withColumn("_curve", curve_number(cells)).repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    writer = laid.drop("_curve").write.mode("append").partitionBy(*DATE_PARTS)
    writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.bloom.filter.enabled#key", "true")
    if keys_in_a_file is not None:
        writer = writer.option("parquet.bloom.filter.expected.ndv#key", keys_in_a_file)
    writer.parquet(path)


def in_box(
    table: DataFrame,
    start: str | datetime,
    end: str | datetime,
    south: float,
    north: float,
    west: float,
    east: float,
    zone: str = "UTC",
) -> DataFrame:
    """Rows with ``start <= time < end`` and a pickup point in the box, its borders included; all of it reaches the scan."""
    latitude, longitude = (F.col(c) for c in BOX)
    inside = latitude.between(float(south), float(north)) & longitude.between(float(west), float(east))
    return in_date_range(table, start, end, zone=zone).filter(inside)
