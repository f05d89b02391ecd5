"""Days of a table replaced by a batch that may be run again."""

from datetime import datetime
from pathlib import Path

import pytest
from helpers import bag, plan, rides
from pyspark.sql import functions as F

from ridelake.operators.events import parse_events, to_events
from ridelake.operators.regions import build_regions
from ridelake.plans.curation import curate, curated
from ridelake.schemas import CURATED, DATE_PARTS, RAW
from ridelake.sources import driver_tables
from ridelake.sources.lake import HIDDEN, append_partitioned, read_table, replace_days

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def source(spark):
    return parse_events(to_events(driver_tables.rides(spark, TABLES).filter("pickup_datetime < '2024-01-05'"))).cache()


@pytest.fixture(scope="module")
def nations(spark):
    return driver_tables.neighborhoods(spark, TABLES)


def files(folder, day=None):
    """Files with what tells whether they were written anew."""
    found = {str(p.relative_to(folder)): (p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(folder).rglob("*.parquet")}
    return {name: fact for name, fact in found.items() if day is None or f"day={day}/" not in name}


def test_only_the_named_days_change(spark, source, nations, folder):
    curate(source, nations, folder, replace=True)
    whole, before = bag(read_table(spark, folder, CURATED)), files(folder, 3)
    third = source.filter("day = 3")
    few = third.filter("pickup_longitude < -74.1")
    curate(few, nations, folder, replace=True)
    # Regions that the day no longer has are gone.
    regions = build_regions(nations)
    expected = bag(curated(source.filter("day <> 3"), regions)) + bag(curated(few, regions))
    assert bag(read_table(spark, folder, CURATED)) == expected != whole
    curate(third, nations, folder, replace=True)
    curate(third, nations, folder, replace=True)
    assert bag(read_table(spark, folder, CURATED)) == whole
    assert files(folder, 3) == before and not Path(folder, HIDDEN).exists()


def test_days_without_rows_go(spark, source, nations, folder):
    curate(source, nations, folder, replace=True)
    days = spark.createDataFrame([(2024, 1, 3), (2024, 1, 4), (1999, 1, 1)], DATE_PARTS)
    curate(source.filter("day = 4"), nations, folder, replace=True, days=days)
    assert {r["day"] for r in read_table(spark, folder, CURATED).select("day").distinct().collect()} == {1, 2, 4}


def test_rows_of_other_days_are_refused(spark, source, folder):
    append_partitioned(source, folder)
    before = files(folder)
    with pytest.raises(ValueError, match="not to be replaced"):
        replace_days(source, folder, source.filter("day = 3"))
    assert files(folder) == before and not Path(folder, HIDDEN).exists()
    with pytest.raises(ValueError, match="partitioned by"):
        replace_days(source, folder, source, ["day", "year"])


def test_a_run_that_failed_is_run_again(spark, source, folder, monkeypatch):
    from ridelake.sources import lake

    replace_days(source, folder, source)
    whole, moved = bag(read_table(spark, folder, RAW)), []

    def fails(spark, old, new):
        moved.append(old)
        if len(moved) > 1:
            raise RuntimeError("lost")
        return real(spark, old, new)

    real = lake.move_folder
    with monkeypatch.context() as broken:
        broken.setattr(lake, "move_folder", fails)
        with pytest.raises(RuntimeError):
            replace_days(source, folder, source)
    # Readers see no row of the unfinished run twice.
    assert not bag(read_table(spark, folder, RAW)) - whole
    replace_days(source, folder, source)
    assert bag(read_table(spark, folder, RAW)) == whole


def test_rides_without_a_time_are_a_day_too(spark, folder):
    raw = parse_events(to_events(rides(spark, ("a", 1.0, None, -74.0, 40.0), ("b", 1.0, "2024-01-01 00:00:00", -74.0, 40.0))))
    for fare in (1.0, 2.0):
        replace_days(raw.withColumn("fare_amount", F.lit(fare).cast("float")), folder, raw)
    assert bag(read_table(spark, folder, RAW), "key", "fare_amount") == {("a", 2.0): 1, ("b", 2.0): 1}


def test_a_new_table_and_an_empty_batch(spark, source, folder):
    replace_days(source.limit(0), f"{folder}/t", source.limit(0))
    replace_days(source, f"{folder}/t", source)
    replace_days(source.limit(0), f"{folder}/t", source.limit(0))
    assert read_table(spark, f"{folder}/t", RAW).count() == source.count()


def test_a_stream_does_not_replace(spark, source, nations, folder):
    append_partitioned(source, f"{folder}/raw")
    stream = spark.readStream.schema(RAW).parquet(f"{folder}/raw")
    with pytest.raises(ValueError, match="only a batch"):
        curate(stream, nations, f"{folder}/out", f"{folder}/c", replace=True)


def test_a_rerun_parses_its_events_once(spark, folder, monkeypatch):
    from ridelake.plans import catalog

    names = "event_id bigint, user_id bigint, ts timestamp, value double"
    rows = [(i, i % 7, datetime(2024, 1, 8 + i % 3, i % 24), 1.0 + i) for i in range(60)]
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/events.parquet")
    nations = [(i, f"place {i}") for i in range(25)]
    spark.createDataFrame(nations, "n_nationkey bigint, n_name string").write.parquet(f"{folder}/nation.parquet")
    plans = []

    def watched(rides, *args, **more):
        plans.append(plan(rides))
        return curate(rides, *args, **more)

    monkeypatch.setattr(catalog, "curate", watched)
    found = catalog.curate_rerun(spark, folder)
    # The days of the rides and the rides themselves are read three times each.
    assert len(plans) == 3 and not any("from_json" in p for p in plans)
    assert bag(found) == bag(catalog.curate_batch(spark, folder))
