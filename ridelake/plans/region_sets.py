"""How many rides lie in any of several regions.

A ride counts once in every region of its cluster, so counts per region must not be added up. What can be put together are
sets of rides. Per day and region they are stored as bitmaps: every ride of a day has a number within one of the day's
buckets, and a bitmap has a bit for each of ``BITS`` numbers. Joining sets is an OR of bitmaps, counting is
counting bits; both are exact, and neither reads a ride again.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.schemas import CURATED, DATE_PARTS
from ridelake.sources.lake import replace_days

# Fixed value: the numbers that one of Spark's bitmaps holds.
BITS = 32768
RIDE = [name for name in CURATED.names if name != "pickup_region"]
SETS = "year smallint, month tinyint, day tinyint, pickup_region string, bucket int, chunk bigint, rides binary"


def ride_sets(rows: DataFrame, buckets: int | None = None) -> DataFrame:
    """Bitmaps of the rides of curated rows per day and region: ``bucket``, ``chunk`` and ``rides``.

    Rows alike in all but the region are one ride. A day's rides are dealt by their hash to ``buckets`` (default: so many
    that a bucket has about ``BITS`` rides of the fullest day and region) and numbered there in the order of their
    columns, so neither a hot day nor a hot region is in one task, and a task run again gives the same numbers.
    Rows without a region lie in none and are left out.
    """
    placed = rows.filter(F.col("pickup_region").isNotNull())
    if buckets is None:
        fullest = placed.groupBy(*DATE_PARTS, "pickup_region").count().agg(F.max("count")).first()[0] or 0
        buckets = fullest // BITS + 1
    one_each = placed.groupBy(*RIDE).agg(F.collect_set("pickup_region").alias("regions"))
    bucket = F.pmod(F.xxhash64(*RIDE), F.lit(buckets)).cast("int")
    along = Window.partitionBy(*DATE_PARTS, "bucket").orderBy(*RIDE)
    numbered = one_each.withColumn("bucket", bucket).withColumn("number", F.row_number().over(along).cast("bigint") - 1)
    each = numbered.select(*DATE_PARTS, "bucket", "number", F.explode("regions").alias("pickup_region"))
    chunk = F.floor(F.col("number") / BITS).alias("chunk")
    sets = each.groupBy(*DATE_PARTS, "pickup_region", "bucket", chunk)
    found = sets.agg(F.bitmap_construct_agg(F.col("number") % BITS).alias("rides"))
    return found.select(*[part.split()[0] for part in SETS.split(", ")])


def write_ride_sets(rows: DataFrame, path: str, buckets: int | None = None) -> None:
    """Stores the sets of all days that the curated rows have; give whole days. May be run again."""
    replace_days(ride_sets(rows, buckets), path, rows.select(*DATE_PARTS))


def _per_day(chunks: DataFrame, name: str) -> DataFrame:
    return chunks.groupBy(name, *DATE_PARTS).agg(F.sum("rides").alias("rides"))


def rides_in_any(sets: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """``name``, the date parts and ``rides``: how many rides lie in any region of each group.

    ``groups`` has rows of ``name`` and ``pickup_region``; a region may be in several groups, and repeated rows
    change nothing. Bitmaps are joined in the map tasks. A day on which a group has no ride has no row.
    """
    wanted = groups.select(name, "pickup_region").distinct()
    met = sets.join(wanted, "pickup_region").groupBy(name, *DATE_PARTS, "bucket", "chunk")
    either = met.agg(F.bitmap_count(F.bitmap_or_agg("rides")).alias("rides"))
    return _per_day(either, name)


def rides_in_all(sets: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """The same for the rides that lie in every region of a group; a day without one has no row."""
    wanted = groups.select(name, "pickup_region").distinct()
    sizes = wanted.groupBy(name).agg(F.count("*").alias("size"))
    met = sets.join(wanted, "pickup_region").groupBy(name, *DATE_PARTS, "bucket", "chunk")
    both = met.agg(F.bitmap_count(F.bitmap_and_agg("rides")).alias("rides"), F.count("*").alias("found")).join(sizes, name)
    return _per_day(both.filter("found = size and rides > 0"), name)
