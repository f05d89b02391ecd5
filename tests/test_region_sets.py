"""Sets of rides per day and region, and counts over several regions."""

from collections import Counter, defaultdict

import pytest
from helpers import bag
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.events import parse_events, to_events
from ridelake.operators.regions import build_regions
from ridelake.plans import region_sets
from ridelake.plans.curation import curated
from ridelake.plans.region_sets import RIDE, SETS, ride_sets, rides_in_all, rides_in_any, write_ride_sets
from ridelake.schemas import CURATED, DATE_PARTS
from ridelake.sources import driver_tables
from ridelake.sources.lake import read_table

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    raw = parse_events(to_events(driver_tables.rides_by_user(spark, TABLES).filter("pickup_datetime < '2024-01-05'")))
    regions = build_regions(driver_tables.neighborhoods(spark, TABLES))
    return curated(raw, regions, by_interval=True).cache()


def by_hand(rows, groups):
    wanted = defaultdict(set)
    for name, region in groups:
        wanted[region].add(name)
    found = defaultdict(set)
    for row in rows.collect():
        for name in wanted.get(row["pickup_region"], ()):
            found[(name, *(row[p] for p in DATE_PARTS))].add(tuple(row[c] for c in RIDE))
    return Counter((*key, len(rides)) for key, rides in found.items())


GROUPS = [("a", "NATION_1"), ("a", "NATION_13"), ("a", "NATION_2"), ("b", "NATION_2"), ("b", "NATION_2"), ("none", "NOWHERE")]


@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_counts_over_sets_are_exact(spark, rows, buckets):
    groups = spark.createDataFrame(GROUPS, "name string, pickup_region string")
    found = rides_in_any(ride_sets(rows, buckets), groups, "name")
    assert bag(found, "name", *DATE_PARTS, "rides") == by_hand(rows, GROUPS)
    single = sum(r["rides"] for r in rides_in_any(ride_sets(rows), groups.filter("name = 'a'"), "name").collect())
    assert single < rows.filter(F.col("pickup_region").isin("NATION_1", "NATION_13", "NATION_2")).count()


def test_rides_in_all_regions_of_a_group(spark, rows):
    pairs = [("ab", "NATION_1"), ("ab", "NATION_13"), ("far", "NATION_1"), ("far", "NATION_2"), ("one", "NATION_2"), ("no", "NOWHERE"), ("no", "NATION_1")]
    moved = rows.filter("pickup_region = 'NATION_1' and fare_amount > 50").withColumn("pickup_region", F.lit("NATION_2"))
    rows = rows.unionAll(moved).distinct()
    found = bag(rides_in_all(ride_sets(rows, 3), spark.createDataFrame(pairs, "name string, pickup_region string"), "name"), "name", *DATE_PARTS, "rides")
    regions_of = defaultdict(set)
    for row in rows.collect():
        regions_of[tuple(row[c] for c in RIDE)].add(row["pickup_region"])
    expected = Counter()
    for name in {n for n, _ in pairs}:
        wanted = {region for n, region in pairs if n == name}
        days = Counter(ride[-3:] for ride, regions in regions_of.items() if wanted <= regions)
        expected.update((name, *day, n) for day, n in days.items())
    assert found == expected and any(row[0] == "far" for row in expected)


def test_more_rides_than_a_bitmap_holds(spark):
    values = {f.name: F.lit(None).cast(f.dataType) for f in CURATED}
    day = {"year": F.lit(2024).cast("smallint"), "month": F.lit(1).cast("tinyint"), "day": F.lit(1).cast("tinyint")}
    many = spark.range(70_000).select(*[v.alias(n) for n, v in {**values, **day, "key": F.col("id").cast("string")}.items()])
    rows = many.withColumn("pickup_region", F.lit("x")).unionAll(many.limit(40_000).withColumn("pickup_region", F.lit("y")))
    groups = spark.createDataFrame([("both", "x"), ("both", "y"), ("one", "y")], "name string, pickup_region string")
    for sets in (ride_sets(rows, 1), ride_sets(rows)):
        assert {r["name"]: r["rides"] for r in rides_in_any(sets, groups, "name").collect()} == {"both": 70_000, "one": 40_000}
    assert ride_sets(rows, 1).groupBy("pickup_region").count().filter("count >= 2").count() == 2
    assert ride_sets(rows).select("bucket").distinct().count() == 70_000 // region_sets.BITS + 1


def test_a_day_may_be_stored_again(spark, rows, folder):
    write_ride_sets(rows, folder)
    write_ride_sets(rows.filter("day = 2"), folder)
    kept = read_table(spark, folder, T.StructType.fromDDL(SETS))
    assert bag(kept.withColumn("rides", F.hex("rides"))) == bag(ride_sets(rows).withColumn("rides", F.hex("rides")))


def test_rows_without_region_and_empty_tables(spark, rows):
    groups = spark.createDataFrame([("a", None), ("a", "NATION_1")], "name string, pickup_region string")
    lost = rows.withColumn("pickup_region", F.lit(None).cast("string"))
    assert ride_sets(lost).isEmpty() and ride_sets(rows.limit(0)).isEmpty()
    assert rides_in_any(ride_sets(rows), groups.limit(0), "name").isEmpty()
    assert bag(rides_in_any(ride_sets(rows), groups, "name"), "name", *DATE_PARTS, "rides") == by_hand(rows, [("a", "NATION_1")])
