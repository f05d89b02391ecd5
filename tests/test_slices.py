"""Rides published in slices of few rows: streams with state take one at a time, in order of time."""

from pathlib import Path

from helpers import bag, rides
from pyspark.sql import functions as F

from ridelake.operators.events import parse_events, to_events
from ridelake.operators.regions import build_regions
from ridelake.plans import catalog
from ridelake.plans.curation import curated
from ridelake.schemas import CURATED, RIDES
from ridelake.sources import driver_tables
from ridelake.sources.event_log import read_event_stream, read_events
from ridelake.streaming.replay import replay_parts, time_slices
from ridelake.streaming.sinks import finish, start_append

TABLES = "/root/testdata/sf0.001"


def at_seconds(spark, seconds):
    times = [None if s is None else f"2024-01-01 00:{s // 60:02}:{s % 60:02}" for s in seconds]
    return rides(spark, *[(str(i), 1.0, time, -73.98, 40.75, -73.98, 40.75, 1) for i, time in enumerate(times)])


def sliced(source, parts, rows):
    by, slices = time_slices(source, parts, rows)
    found = source.select(F.unix_micros("pickup_datetime").alias("at"), by.alias("slice")).collect()
    return [(r["at"], r["slice"]) for r in found], slices


def test_slices_are_in_order_of_time_and_hold_few_rows(spark):
    # Most of the rides lie in a short time.
    seconds = [*range(0, 3600, 60), *[1800 + i % 60 for i in range(300)], None, None]
    found, slices = sliced(at_seconds(spark, seconds), 3, 40)
    assert slices == 4 and {s for _, s in found} == set(range(12))
    timed = sorted((at, s) for at, s in found if at is not None)
    assert [s for _, s in timed] == sorted(s for _, s in timed)
    assert all(s == 0 for at, s in found if at is None)
    counts = [sum(s == n for _, s in timed) for n in range(12)]
    assert max(counts) <= 40


def test_few_rows_or_none_are_one_slice_a_part(spark):
    assert sliced(at_seconds(spark, [5, 6, 7]), 3, 1000)[1] == 1
    assert sliced(at_seconds(spark, [5] * 50), 3, 4)[0] == sliced(at_seconds(spark, [5] * 50), 3, 4)[0]
    assert sliced(spark.createDataFrame([], RIDES), 3, 4) == ([], 1)
    assert {s for _, s in sliced(at_seconds(spark, [None] * 9), 3, 1)[0]} == {0}


def test_a_part_is_published_as_one_file_a_slice_in_order(spark, folder):
    source = at_seconds(spark, range(90))
    by, slices = time_slices(source, 2, 15)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "4")
    try:
        published = []
        for _ in replay_parts(to_events(source, keep=("pickup_datetime",)), f"{folder}/log", f"{folder}/staged", 2, by, slices=slices):
            published.append(len(list(Path(folder, "log").glob("*.parquet"))))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert slices == 3 and published == [3, 6]
    assert bag(read_events(spark, f"{folder}/log").select("key")) == bag(source.select("key"))
    # A stream that takes one file at a time meets them in order of time.
    stream = parse_events(read_event_stream(spark, f"{folder}/log", max_files=1))
    query = start_append(stream.select("key", "pickup_datetime"), f"{folder}/out", f"{folder}/c", available_now=True)
    finish(query)
    assert len(query.recentProgress) == 6
    taken = [p["numInputRows"] for p in query.recentProgress]
    assert sum(taken) == 90 and max(taken) <= 16


def test_a_reattaching_streams_state_holds_a_slice_or_two(spark, monkeypatch):
    progress = []

    def watched(query):
        finish(query)
        progress.extend(query.recentProgress)

    monkeypatch.setattr(catalog, "SLICE_ROWS", 60)
    monkeypatch.setattr(catalog, "finish", watched)
    found = catalog.QUERIES["stream_reattach"](spark, TABLES)
    source = driver_tables.delivered_twice(driver_tables.untimed(driver_tables.rides_by_user(spark, TABLES), "ride"))
    regions = build_regions(driver_tables.neighborhoods(spark, TABLES))
    batch = curated(parse_events(to_events(source)), regions, by_interval=True)
    assert bag(found) == bag(catalog._plain(batch.select(*CURATED.names)))
    # The rides that wait for their slot to close: without slices a third of all.
    waiting = max(s["numRowsTotal"] for p in progress for s in p["stateOperators"] if s["operatorName"] == "symmetricHashJoin")
    assert 0 < waiting <= 2 * 60 + 20 < source.count() / 4
