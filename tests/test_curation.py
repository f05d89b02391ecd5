import pytest
from helpers import bag, places, plan, rides
from pyspark.sql import functions as F

from ridelake.operators.events import parse_events, to_events
from ridelake.operators.regions import Regions, assign_cluster, build_regions
from ridelake.operators.rows import with_coordinates
from ridelake.plans.curation import curate, curated, to_curated
from ridelake.plans.fares import fares_by_day, fares_by_day_region, fares_by_day_region_of
from ridelake.schemas import CURATED
from ridelake.sources import driver_tables
from ridelake.sources.lake import read_table

TABLES = "/root/testdata/sf0.001"
NOON = "2024-01-01 12:00:00"


@pytest.fixture(scope="module")
def regions(spark):
    return build_regions(driver_tables.neighborhoods(spark, TABLES))


def raw(df):
    return parse_events(to_events(df))


def test_curated_types_and_values_that_do_not_fit(spark):
    ride = ("a", 6.25, NOON, 12.25040049, 51.501209, -173.5, 51.4, 208)
    out = to_curated(raw(rides(spark, ride, ride)).withColumn("pickup_region", F.lit("r")))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CURATED]
    rows = out.collect()
    assert len(rows) == 1
    assert str(rows[0]["pickup_longitude"]) == "12.250400"
    assert rows[0]["dropoff_longitude"] is None and rows[0]["passenger_count"] is None
    assert to_curated(raw(rides(spark, ride, ride)).withColumn("pickup_region", F.lit("r")), distinct=False).count() == 2


def test_duplicates_are_removed_on_the_final_types(spark, regions):
    """Two rides that differ beyond the sixth decimal are one curated ride."""
    twins = rides(spark, ("a", 1.0, NOON, -74.2000001, 40.5), ("a", 1.0, NOON, -74.2000002, 40.5))
    per_ride = regions.dim.groupBy("pickup_cluster").count().agg(F.max("count")).first()[0]
    assert curated(raw(twins), regions).count() <= per_ride
    assert bag(curated(raw(twins), regions)) == bag(curated(raw(twins), regions, distinct=False).distinct())


@pytest.mark.parametrize("by_interval", [False, True])
def test_curation_equals_the_plain_plan(spark, regions, by_interval):
    """Fan out first, join on key and time, cast, and remove duplicates last."""
    source = raw(driver_tables.delivered_twice(driver_tables.rides(spark, TABLES)))
    if by_interval:
        source = raw(driver_tables.rides_by_user(spark, TABLES))
    kept = with_coordinates(source)
    fanned = assign_cluster(kept, regions.model).join(regions.dim, "pickup_cluster", "left")
    near = fanned.selectExpr("key AS k", "pickup_datetime AS t", "pickup_region")
    joined = kept.join(
        near,
        F.expr("key = k AND pickup_datetime BETWEEN t - INTERVAL 10 MINUTES AND t + INTERVAL 10 MINUTES"),
        "left",
    ).drop("k", "t")
    assert bag(curated(source, regions, by_interval=by_interval)) == bag(to_curated(joined))


def test_both_ways_agree_where_keys_are_unique(spark, regions):
    source = raw(driver_tables.rides(spark, TABLES))
    assert bag(curated(source, regions)) == bag(curated(source, regions, by_interval=True))


def test_a_nearby_ride_of_the_same_key_shares_its_regions(spark, regions):
    source = raw(rides(spark, ("k", 1.0, NOON, -74.2, 40.5), ("k", 2.0, "2024-01-01 12:10:00", -73.9, 40.6)))
    own = curated(source, regions).groupBy("fare_amount").count()
    shared = curated(source, regions, by_interval=True).groupBy("fare_amount").count()
    total = sum(r["count"] for r in own.collect())
    assert {r["count"] for r in shared.collect()} == {total}


def test_a_point_that_is_no_number_stays_without_region(spark, regions):
    source = raw(rides(spark, ("n", 1.0, NOON, float("nan"), 40.5)))
    for by_interval in (False, True):
        rows = curated(source, regions, by_interval=by_interval).collect()
        assert [r["pickup_region"] for r in rows] == [None]


def test_a_region_in_two_clusters_gives_no_duplicates(spark):
    spots = places(spark, ("Same", 40.5, -74.2), ("Same", 40.500001, -74.2), ("Other", 41.0, -73.0))
    shared = build_regions(spots, k=3)
    assert not shared.separate
    twins = rides(spark, ("a", 1.0, NOON, -74.2, 40.50000049), ("a", 1.0, NOON, -74.2, 40.50000045))
    for by_interval in (False, True):
        out = curated(raw(twins), shared, by_interval=by_interval)
        assert bag(out) == bag(out.distinct())


def test_rides_are_deduplicated_before_the_fan_out(spark, regions):
    text = plan(curated(raw(driver_tables.rides(spark, TABLES)), regions))
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")
    assert text.count("Exchange\n") <= 2


def test_batch_curation_writes_by_date_and_region(spark, regions, folder):
    source = raw(driver_tables.rides(spark, TABLES))
    assert curate(source, driver_tables.neighborhoods(spark, TABLES), f"{folder}/out") is None
    back = read_table(spark, f"{folder}/out", CURATED)
    assert set(back.columns) == set(CURATED.names)
    assert bag(back) == bag(curated(source, regions))
    assert back.schema["day"].dataType == CURATED["day"].dataType
    some = back.first()
    one = back.filter(F.col("pickup_region") == some["pickup_region"]).filter(F.col("day") == int(some["day"]))
    assert "PartitionFilters: [isnotnull(pickup_region" in plan(one) and one.count() > 0


def test_batch_curation_of_shared_regions_writes_no_duplicates(spark, folder):
    spots = places(spark, ("Same", 40.5, -74.2), ("Same", 40.6, -74.2), ("Other", 41.0, -73.0))
    twice = raw(rides(spark, ("a", 1.0, NOON, -74.2, 40.5), ("a", 1.0, NOON, -74.2, 40.5)))
    curate(twice, spots, f"{folder}/out", k=3)
    assert read_table(spark, f"{folder}/out", CURATED).count() == 1


def test_curation_checks_the_zone(spark, folder, zone):
    zone("-03:00")
    source = raw(rides(spark, ("a", 1.0, NOON, -74.2, 40.5)))
    with pytest.raises(ValueError, match="time zone"):
        curate(source, driver_tables.neighborhoods(spark, TABLES), f"{folder}/out")


def test_fares_are_exact_and_null_safe(spark):
    df = rides(
        spark,
        ("a", 0.1, NOON, -74.2, 40.5),
        ("b", 0.2, NOON, -74.2, 40.5),
        ("c", None, NOON, -74.2, 40.5),
        ("d", None, "2024-01-02 00:00:00", -74.2, 40.5),
    )
    rows = {str(r["pickup_day"]): r for r in fares_by_day(raw(df)).collect()}
    assert (rows["2024-01-01"]["rides"], rows["2024-01-01"]["fare_cents"]) == (3, 30)
    assert rows["2024-01-01"]["avg_fare"] == 0.15
    assert (rows["2024-01-02"]["rides"], rows["2024-01-02"]["avg_fare"]) == (1, None)


def test_early_sums_equal_sums_over_curated_rides(spark, regions):
    source = with_coordinates(raw(driver_tables.rides(spark, TABLES)))
    late = bag(fares_by_day_region(curated(source, regions)))
    assert bag(fares_by_day_region_of(source, regions)) == late
    joined = Regions(regions.model, regions.dim, regions.k, regions.seed, True, False)
    assert bag(fares_by_day_region_of(source, joined)) == late


def test_no_plan_outgrows_generated_code(spark, regions):
    """The search for the nearest centre stays short even where a filter repeats it."""
    found = assign_cluster(driver_tables.rides(spark, TABLES), regions.model, "keep").filter("pickup_cluster IS NOT NULL")
    assert len(plan(found)) < 40_000
