"""Late rides: kept aside, counted, and counted in."""

from datetime import datetime, timezone

import pytest
from helpers import bag, rides
from pyspark.sql import functions as F

from ridelake.operators.events import parse_events, to_events
from ridelake.operators.regions import build_regions
from ridelake.operators.rows import with_coordinates
from ridelake.schemas import RAW
from ridelake.sources import driver_tables
from ridelake.streaming import late
from ridelake.streaming.fares import window_sums
from ridelake.streaming.late import gated_rides, late_rides, run_window_fares, watermark_of, window_fares_now

TABLES = "/root/testdata/sf0.001"
NAMES = ["window_start", "window_end", "pickup_region", "rides", "fare_cents", "avg_fare"]


@pytest.fixture(scope="module")
def regions(spark):
    return build_regions(driver_tables.neighborhoods(spark, TABLES))


def taken_in(spark, folder, regions, *rows):
    """A run over rides of (key, time), added to the raw table."""
    points = [(key, 1.0, time, -74.1, 40.5) for key, time in rows]
    if rows:
        with_coordinates(parse_events(to_events(rides(spark, *points)))).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    run_window_fares(spark.readStream.schema(RAW).parquet(f"{folder}/raw"), regions, f"{folder}/fares")


def hours(spark, folder):
    """Rides and late rides by hour, of one region."""
    rows = window_fares_now(spark, f"{folder}/fares").groupBy("window_start", "rides", "late_rides").count().collect()
    found = {r["window_start"].strftime("%d %H"): (r["rides"], r["late_rides"]) for r in rows}
    assert len(found) == len(rows)
    return found


def day(hour, minute=0, date=1):
    return f"2024-01-{date:02} {hour:02}:{minute:02}:00"


def test_late_rides_are_counted_in_run_by_run(spark, folder, regions):
    taken_in(spark, folder, regions, ("a", day(1)), ("b", day(2)), ("n", None))
    assert hours(spark, folder) == {} and late_rides(spark, f"{folder}/fares").isEmpty()
    taken_in(spark, folder, regions, ("c", day(9)))
    assert hours(spark, folder) == {"01 01": (1, 0), "01 02": (1, 0)}
    assert watermark_of(spark, f"{folder}/fares/checkpoint_windows") == datetime(2024, 1, 1, 8, 50, tzinfo=timezone.utc)
    # One ride late for a window that has rides, one for a window without, one late but its window is open, one of another day.
    taken_in(spark, folder, regions, ("d", day(1, 59)), ("e", day(5)), ("f", day(8, 1)), ("g", "2023-12-31 23:59:59"))
    assert hours(spark, folder) == {"01 01": (2, 1), "01 02": (1, 0), "01 05": (1, 1), "31 23": (1, 1)}
    assert bag(late_rides(spark, f"{folder}/fares"), "key") == {("d",): 1, ("e",): 1, ("g",): 1}
    taken_in(spark, folder, regions, ("d", day(1, 59)), ("h", day(20)))
    expected = {"01 01": (3, 2), "01 02": (1, 0), "01 05": (1, 1), "01 08": (1, 0), "01 09": (1, 0), "31 23": (1, 1)}
    assert hours(spark, folder) == expected
    taken_in(spark, folder, regions)
    assert hours(spark, folder) == expected and gated_rides(spark, f"{folder}/fares").count() == 10


def test_nothing_is_dropped_by_the_windows(spark, folder, regions):
    source = with_coordinates(parse_events(to_events(driver_tables.rides(spark, TABLES))))
    number = F.col("key").cast("bigint")
    # In no order of time at all: most rides of the later runs are late.
    for run in range(3):
        source.filter(number % 3 == run).coalesce(2).write.mode("append").parquet(f"{folder}/raw")
        taken_in(spark, folder, regions)
    assert late_rides(spark, f"{folder}/fares").count() > 500
    closing = [("closing", "2024-03-01 00:00:00")]
    taken_in(spark, folder, regions, *closing)
    found = window_fares_now(spark, f"{folder}/fares")
    assert bag(found, *NAMES) == bag(window_sums(source, regions), *NAMES)
    late_by_hand = late_rides(spark, f"{folder}/fares")
    assert bag(found.filter("late_rides > 0"), "window_start", "pickup_region", "late_rides") == bag(
        window_sums(late_by_hand, regions).withColumnRenamed("rides", "late_rides"), "window_start", "pickup_region", "late_rides"
    )


def test_a_run_that_fails_is_made_good_by_the_next(spark, folder, regions, monkeypatch):
    taken_in(spark, folder, regions, ("a", day(1)), ("b", day(9)))
    for broken in ("window_fares", "replace_days"):
        with monkeypatch.context() as failing:
            failing.setattr(late, broken, lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                taken_in(spark, folder, regions, ("late", day(1, 30)))
    taken_in(spark, folder, regions)
    assert hours(spark, folder) == {"01 01": (3, 2)}


def test_only_touched_days_are_written_again(spark, folder, regions):
    from pathlib import Path

    def written(part):
        return {p.name for p in Path(folder, "fares/corrections").rglob("*.parquet") if part in str(p)}

    taken_in(spark, folder, regions, ("a", day(1)), ("b", day(1, date=2)), ("c", day(9, date=3)))
    taken_in(spark, folder, regions, ("d", day(2)), ("e", day(2, date=2)))
    first, second = written("day=1/"), written("day=2/")
    taken_in(spark, folder, regions, ("f", day(3, date=2)))
    assert written("day=1/") == first and not written("day=2/") & second
    assert hours(spark, folder)["02 03"] == (1, 1)


def test_no_checkpoint_means_no_watermark(spark, folder):
    assert watermark_of(spark, f"{folder}/none") is None
