from pathlib import Path

import pytest
from helpers import bag, rides
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.events import parse_events, split_bad_records, to_events
from ridelake.operators.joins import interval_left_join
from ridelake.operators.regions import build_regions
from ridelake.operators.rows import with_coordinates
from ridelake.plans.curation import curate, curated
from ridelake.plans.pipeline import run_pipeline
from ridelake.schemas import CURATED, RAW
from ridelake.sources import driver_tables
from ridelake.sources.event_log import read_event_stream, read_events, write_events
from ridelake.sources.lake import append_partitioned, read_table
from ridelake.streaming.fares import window_fares
from ridelake.streaming.landing import first_deliveries, land, read_raw_stream, with_lateness
from ridelake.streaming.replay import random_part, replay, replay_parts, time_part
from ridelake.streaming.sinks import finish, start_append

TABLES = "/root/testdata/sf0.001"
CURATED_NAMES = sorted(CURATED.names)


@pytest.fixture(scope="module")
def source(spark):
    """The rides of the first four days."""
    return driver_tables.rides(spark, TABLES).filter("pickup_datetime < '2024-01-05'")


@pytest.fixture(scope="module")
def total(source):
    return source.count()


@pytest.fixture(scope="module")
def nations(spark):
    return driver_tables.neighborhoods(spark, TABLES)


@pytest.fixture(scope="module")
def regions(nations):
    return build_regions(nations)


def in_time_order(source, folder, parts=3):
    events = to_events(source, keep=("pickup_datetime",))
    return replay_parts(events, f"{folder}/log", f"{folder}/staged", parts, time_part(source, parts))


def then_closed(source, folder, parts=3):
    """The same, and a ride long after them all, whose key is ``closing``."""
    yield from in_time_order(source, folder, parts)
    write_events(to_events(driver_tables.closing_ride(source)), f"{folder}/log")
    yield parts


def test_replay_publishes_every_event_once(spark, source, folder):
    assert replay(to_events(source), f"{folder}/log", f"{folder}/staged", parts=10, pause=0) == 10
    assert bag(read_events(spark, f"{folder}/log")) == bag(to_events(source))


def test_replay_skips_empty_parts(spark, folder):
    few = to_events(rides(spark, ("1", 1.0, "2024-01-01 00:00:00", -74.0, 40.0)))
    assert replay(few, f"{folder}/log", f"{folder}/staged", parts=10, pause=0) == 1
    assert read_events(spark, f"{folder}/log").count() == 1
    assert not Path(folder, "staged").exists()
    few.write.parquet(f"{folder}/staged")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        replay(few, f"{folder}/log", f"{folder}/staged", parts=10, pause=0)


def test_random_parts_can_be_repeated_by_seed(spark, source):
    once, again = (source.select("key", random_part(10, 5).alias("p")) for _ in range(2))
    assert bag(once) == bag(again)
    assert {r["p"] for r in once.collect()} == set(range(10))


def test_landing_equals_batch_parsing_with_broken_and_repeated_events(spark, folder):
    events = driver_tables.delivered_twice(driver_tables.broken_events(spark, TABLES))
    write_events(events, f"{folder}/log")
    finish(land(read_event_stream(spark, f"{folder}/log"), f"{folder}/raw", f"{folder}/c", available_now=True))
    assert bag(read_table(spark, f"{folder}/raw", RAW)) == bag(parse_events(events))


def test_a_restart_adds_only_new_events(spark, source, total, folder):
    def run():
        stream = read_event_stream(spark, f"{folder}/log", max_files=1)
        finish(land(stream, f"{folder}/raw", f"{folder}/c", available_now=True, files_per_day=2))
        return read_table(spark, f"{folder}/raw", RAW).count()

    write_events(to_events(source).repartition(3), f"{folder}/log")
    assert run() == total
    assert run() == total
    write_events(to_events(source.filter("key = '5'")), f"{folder}/log")
    assert run() == total + 1


def test_a_running_query_can_be_stopped(spark, source, total, folder):
    write_events(to_events(source), f"{folder}/log")
    stream = read_event_stream(spark, f"{folder}/log")
    query = land(stream, f"{folder}/raw", f"{folder}/c", every="1 second")
    query.processAllAvailable()
    assert query.isActive and not query.status["message"].startswith("Terminated")
    query.stop()
    assert read_table(spark, f"{folder}/raw", RAW).count() == total


@pytest.mark.parametrize("files_per_region", [None, 1])
def test_stream_curation_equals_batch_and_keeps_its_regions(spark, source, nations, regions, folder, files_per_region):
    raw = parse_events(to_events(source))
    append_partitioned(raw, f"{folder}/raw")

    def run(places):
        stream = read_raw_stream(spark, f"{folder}/raw", max_files=8)
        finish(
            curate(
                stream, places, f"{folder}/out", f"{folder}/c", available_now=True, files_per_region=files_per_region
            )
        )
        return read_table(spark, f"{folder}/out", CURATED)

    assert bag(run(nations)) == bag(curated(raw, regions))
    moved = nations.withColumn("latitude", (F.col("latitude") + 1).cast("decimal(8,6)"))
    append_partitioned(raw, f"{folder}/raw")
    assert bag(run(moved)) == bag(curated(raw, regions).unionAll(curated(raw, regions)))


def test_default_streams_keep_no_state_and_shuffle_no_ride(spark, source, nations, folder):
    write_events(to_events(source.limit(20)), f"{folder}/log")
    landing = land(read_event_stream(spark, f"{folder}/log"), f"{folder}/raw", f"{folder}/c1", available_now=True)
    finish(landing)
    curating = curate(
        read_raw_stream(spark, f"{folder}/raw"), nations, f"{folder}/out", f"{folder}/c2", available_now=True
    )
    finish(curating)
    plans = [query._jsq.explainInternal(False) for query in (landing, curating)]
    assert "BroadcastHashJoin" in plans[1] and "LeftOuter" in plans[1]
    for query, text in zip((landing, curating), plans):
        assert "Exchange hashpartitioning" not in text and "StateStore" not in text
        assert all(not p["stateOperators"] for p in query.recentProgress)


def test_bad_records_can_be_split_on_a_stream(spark, folder):
    write_events(spark.createDataFrame([("a", '{"fare_amount": 1.0}'), ("b", "{bad")], "key string, value string"), f"{folder}/log")
    good, bad = split_bad_records(read_event_stream(spark, f"{folder}/log"))
    finish(start_append(good, f"{folder}/good", f"{folder}/c1", available_now=True))
    finish(start_append(bad, f"{folder}/bad", f"{folder}/c2", available_now=True))
    assert bag(spark.read.parquet(f"{folder}/good"), "key", "fare_amount") == {("a", 1.0): 1}
    assert bag(spark.read.parquet(f"{folder}/bad"), "key", "value") == {("b", "{bad"): 1}


def test_stream_curation_needs_a_checkpoint(spark, source, nations, folder):
    append_partitioned(parse_events(to_events(source)), f"{folder}/raw")
    with pytest.raises(ValueError, match="checkpoint"):
        curate(read_raw_stream(spark, f"{folder}/raw"), nations, f"{folder}/out")


@pytest.mark.parametrize("by_interval", [False, True])
def test_stateful_curation_equals_batch_on_input_in_time_order(spark, source, nations, regions, folder, by_interval):
    twice = driver_tables.delivered_twice(source)
    for _ in then_closed(twice, folder, 2):
        stream = parse_events(read_event_stream(spark, f"{folder}/log"))
        finish(
            curate(
                stream,
                nations,
                f"{folder}/out",
                f"{folder}/c",
                distinct=True,
                by_interval=by_interval,
                available_now=True,
            )
        )
    expected = curated(parse_events(to_events(twice)), regions, by_interval=by_interval)
    assert bag(read_table(spark, f"{folder}/out", CURATED).filter("key <> 'closing'")) == bag(expected)


def test_windows_come_out_once_when_closed(spark, source, regions, folder):
    for _ in in_time_order(source, folder, 2):
        rows = with_coordinates(parse_events(read_event_stream(spark, f"{folder}/log")))
        finish(start_append(window_fares(rows, regions), f"{folder}/out", f"{folder}/c", available_now=True))
    kept = with_coordinates(parse_events(to_events(source)))
    last = kept.agg((F.max("pickup_datetime") - F.expr("INTERVAL 10 MINUTES")).alias("last"))
    expected = window_fares(kept, regions).join(last, F.col("window_end") <= F.col("last")).drop("last")
    assert bag(spark.read.parquet(f"{folder}/out")) == bag(expected)


def test_windows_are_the_same_when_regions_are_shared(spark, source, regions):
    from dataclasses import replace

    kept = with_coordinates(parse_events(to_events(source)))
    assert bag(window_fares(kept, replace(regions, separate=False))) == bag(window_fares(kept, regions))


@pytest.mark.parametrize("spread_over", [None, 4])
def test_repeated_deliveries_are_dropped_across_batches(spark, source, folder, spread_over):
    first = to_events(source.filter("key < '5'"))
    unknown = spark.createDataFrame([(None, "{}"), (None, "{}"), ("x", "{bad"), ("x", "{bad")], "key string, value string")
    for events in (first.unionAll(first).unionAll(unknown), first, unknown):
        write_events(events, f"{folder}/log")
        rows = first_deliveries(parse_events(read_event_stream(spark, f"{folder}/log")), "60 days", spread_over)
        query = start_append(rows, f"{folder}/out", f"{folder}/c", available_now=True)
        finish(query)
        assert query._jsq.explainInternal(False).count("from_json") <= 1
    out = spark.read.parquet(f"{folder}/out")
    assert bag(out, "key") == bag(first, "key") + bag(unknown, "key") + bag(unknown, "key")


def test_copies_of_a_hot_delivery_hardly_reach_its_task(spark, folder):
    """Of 20,000 copies, the step that has all rows of a key in one task gets as many as there are salts."""
    ride = to_events(rides(spark, ("hot", 1.0, "2024-01-01 00:00:00", -74.0, 40.0)))
    copies = ride.crossJoin(spark.range(20_000, numPartitions=8)).select("key", "value")
    write_events(copies, f"{folder}/log")
    stream = read_event_stream(spark, f"{folder}/log")
    query = land(stream, f"{folder}/raw", f"{folder}/c", available_now=True, first_only=True, spread_over=4)
    finish(query)
    assert read_table(spark, f"{folder}/raw", RAW).count() == 1
    dropped = [0, 0]
    for progress in query.recentProgress:
        for i, state in enumerate(progress["stateOperators"]):
            dropped[i] += state["customMetrics"]["numDroppedDuplicateRows"]
    # The last step comes first in the report.
    assert min(dropped) < 4 and sum(dropped) == 19_999


def test_landing_can_drop_repeated_deliveries(spark, source, folder):
    twice = driver_tables.delivered_twice(source)
    for _ in in_time_order(twice, folder, 2):
        stream = read_event_stream(spark, f"{folder}/log")
        finish(land(stream, f"{folder}/raw", f"{folder}/c", available_now=True, first_only=True))
    assert bag(read_table(spark, f"{folder}/raw", RAW)) == bag(parse_events(to_events(source)))


def test_late_rows_are_dropped_by_stateful_steps_only(spark, folder):
    early = rides(spark, ("old", 1.0, "2024-01-01 00:00:00", -74.0, 40.0))
    late = rides(spark, ("new", 1.0, "2024-01-01 12:00:00", -74.0, 40.0))
    for part in (late, early):
        write_events(to_events(part), f"{folder}/log")
        parsed = parse_events(read_event_stream(spark, f"{folder}/log"))
        finish(start_append(first_deliveries(parsed), f"{folder}/state", f"{folder}/c1", available_now=True))
        finish(start_append(parsed, f"{folder}/plain", f"{folder}/c2", available_now=True))
    assert bag(spark.read.parquet(f"{folder}/state"), "key") == {("new",): 1}
    assert bag(spark.read.parquet(f"{folder}/plain"), "key") == {("new",): 1, ("old",): 1}


def test_interval_join_on_streams_keeps_unmatched_rows(spark, folder):
    """A left row comes out unmatched once the watermark has passed its interval."""
    lefts = rides(
        spark,
        ("a", 1.0, "2024-01-01 00:00:00", -74.0, 40.0),
        ("b", 2.0, "2024-01-01 00:05:00", -74.0, 40.0),
        ("z", 3.0, "2024-01-02 00:00:00", -74.0, 40.0),
    )
    for part in (lefts.filter("key <> 'z'"), lefts.filter("key = 'z'")):
        write_events(to_events(part), f"{folder}/log")
        raw = with_lateness(parse_events(read_event_stream(spark, f"{folder}/log")))
        right = raw.filter("key <> 'b'").select(
            F.col("key").alias("near_key"),
            F.col("pickup_datetime").alias("near_time"),
            F.col("fare_amount").alias("near"),
        )
        rows = interval_left_join(raw.select("key", "pickup_datetime"), right)
        finish(start_append(rows, f"{folder}/out", f"{folder}/c", available_now=True))
    assert bag(spark.read.parquet(f"{folder}/out"), "key", "near") == {("a", 1.0): 1, ("b", None): 1, ("z", 3.0): 1}


def test_stateful_streams_run_on_the_disk_state_store(spark, source, total, folder):
    from ridelake.session import STATEFUL_STREAMS

    before = {name: spark.conf.get(name, None) for name in STATEFUL_STREAMS}
    for name, value in STATEFUL_STREAMS.items():
        spark.conf.set(name, value)
    try:
        write_events(to_events(driver_tables.delivered_twice(source)), f"{folder}/log")
        rows = first_deliveries(parse_events(read_event_stream(spark, f"{folder}/log")))
        finish(start_append(rows, f"{folder}/out", f"{folder}/c", available_now=True))
        assert spark.read.parquet(f"{folder}/out").count() == total
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_an_interval_stream_keeps_rides_without_a_time(spark, nations, regions, folder):
    source = driver_tables.untimed(driver_tables.rides_by_user(spark, TABLES), "ride").filter("ride < '5'")
    twice = driver_tables.delivered_twice(source)
    for _ in then_closed(twice, folder, 2):
        stream = parse_events(read_event_stream(spark, f"{folder}/log"))
        finish(
            curate(stream, nations, f"{folder}/out", f"{folder}/c", distinct=True, by_interval=True, available_now=True)
        )
    expected = bag(curated(parse_events(to_events(twice)), regions, by_interval=True))
    assert any(row[CURATED_NAMES.index("pickup_datetime")] is None for row in expected)
    assert bag(read_table(spark, f"{folder}/out", CURATED).filter("key <> 'closing'")) == expected


def test_a_new_raw_column_reaches_the_curated_stream(spark, source, nations, regions, folder):
    new = T.StructField("note", T.StringType())
    raw = parse_events(to_events(source))
    append_partitioned(raw, f"{folder}/raw")
    append_partitioned(raw.withColumn("note", F.lit("x")), f"{folder}/raw")
    stream = read_raw_stream(spark, f"{folder}/raw", schema=T.StructType([*RAW.fields, new]))
    finish(curate(stream, nations, f"{folder}/out", f"{folder}/c", more=["note"], available_now=True))
    out = read_table(spark, f"{folder}/out", T.StructType([*CURATED.fields, new]))
    plain = curated(raw, regions, distinct=False).count()
    assert {r["note"]: r["count"] for r in out.groupBy("note").count().collect()} == {None: plain, "x": plain}


def test_a_curating_stream_takes_its_settings(spark, source, nations, folder):
    append_partitioned(parse_events(to_events(source)), f"{folder}/raw")
    query = curate(
        read_raw_stream(spark, f"{folder}/raw"), nations, f"{folder}/out", f"{folder}/c",
        distinct=True, by_interval=True, minutes=3, delay="2 hours", every="1 second",
    )
    try:
        query.processAllAvailable()
        text = query._jsq.explainInternal(False)
        assert query.isActive and "2 hours" in text and "INTERVAL '03' MINUTE" in text
    finally:
        query.stop()


def test_a_bounded_run_adds_few_files(spark, source, nations, folder):
    run_pipeline(source, nations, folder, parts=6, pause=0, max_files=2)
    batches = 6
    for path, schema, cols in ((f"{folder}/raw", RAW, ["day"]), (f"{folder}/curated", CURATED, ["day", "pickup_region"])):
        files = read_table(spark, path, schema).groupBy(*cols).agg(F.count_distinct(F.col("_metadata.file_path")).alias("n"))
        assert files.agg(F.max("n")).first()[0] <= batches
    assert not list(Path(folder, "staged").glob("*"))


def test_the_whole_pipeline_equals_batch_curation(spark, source, nations, regions, folder):
    out = run_pipeline(source, nations, folder, parts=4, pause=0)
    assert bag(out) == bag(curated(parse_events(to_events(source)), regions))
    more = rides(spark, ("late", 3.0, "2024-03-01 00:00:00", -74.2, 40.5))
    again = run_pipeline(more, nations, folder, parts=4, pause=0)
    assert bag(again.filter("key <> 'late'")) == bag(out.filter("key <> 'late'"))
    assert not again.filter("key = 'late'").isEmpty()


def test_a_directory_is_read_from_its_first_file(spark, folder):
    with pytest.raises(ValueError, match="first file"):
        read_event_stream(spark, folder, starting="latest")


def test_kafka_needs_its_connector(spark, source):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_event_stream(spark, "rides", fmt="kafka", **{"kafka.bootstrap.servers": "localhost:1"})
    with pytest.raises(Exception, match="(?i)kafka"):
        write_events(to_events(source), "rides", fmt="kafka")
