"""The state of stopped queries."""

from dataclasses import replace

import pytest
from helpers import bag
from pyspark.sql import functions as F

from ridelake.operators.events import parse_events, to_events
from ridelake.operators.regions import build_regions
from ridelake.operators.rows import with_coordinates
from ridelake.schemas import RAW
from ridelake.sources import driver_tables
from ridelake.streaming.fares import window_fares, window_sums
from ridelake.streaming.sinks import finish, start_append
from ridelake.streaming.state import pending_windows, state_report, state_rows

TABLES = "/root/testdata/sf0.001"


@pytest.mark.parametrize("separate", [True, False])
def test_closed_and_pending_windows_are_all_windows(spark, folder, separate):
    raw = with_coordinates(parse_events(to_events(driver_tables.rides(spark, TABLES).filter("pickup_datetime < '2024-01-06'"))))
    regions = build_regions(driver_tables.neighborhoods(spark, TABLES))
    if not separate:
        shared = regions.dim.withColumn("pickup_region", F.regexp_replace("pickup_region", "1", "2")).distinct()
        regions = replace(regions, dim=shared, separate=False)
    for part in ("day < 3", "day >= 3"):
        raw.filter(part).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        rows = window_fares(spark.readStream.schema(RAW).parquet(f"{folder}/raw"), regions, "1 hour", "20 hours")
        finish(start_append(rows, f"{folder}/out", f"{folder}/c", available_now=True))
    pending, closed = pending_windows(spark, f"{folder}/c", regions), spark.read.parquet(f"{folder}/out")
    assert not pending.isEmpty() and not closed.isEmpty()
    assert bag(pending) + bag(closed) == bag(window_sums(raw, regions, "1 hour"))
    (operator,) = state_report(spark, f"{folder}/c").collect()
    assert operator["operatorName"] == "stateStoreSave"
    # An earlier batch may be read as well: after the first one nothing had been closed.
    assert state_rows(spark, f"{folder}/c", batch=0).count() > state_rows(spark, f"{folder}/c").count() > 0
