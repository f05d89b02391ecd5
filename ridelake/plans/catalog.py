"""The registered queries over the given ``events`` and ``nation`` tables.

Every query reads its tables whole. Queries about writing or streaming put their
tables into a fresh folder under the session's checkpoint folder and read them back.
"""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.events import flag_bad_records, parse_events, to_events
from ridelake.operators.joins import interval_left_join, left_join_small
from ridelake.operators.regions import (
    BROADCAST_BYTES,
    Regions,
    assign_cluster,
    assign_regions,
    build_regions,
    fit_regions,
    label_neighborhoods,
)
from ridelake.operators.nearest import with_nearest_of_many
from ridelake.operators.payload import new_fields, promoted, raw_with
from ridelake.operators.rows import distinct_rows, with_coordinates, with_part
from ridelake.plans.curation import curate, curated, to_curated
from ridelake.plans.fares import fares_by_day, fares_by_day_region_of, fares_of_raw
from ridelake.plans.ingest import land_batch, read_landed
from ridelake.plans.pipeline import run_pipeline
from ridelake.plans.region_sets import SETS, rides_in_any, write_ride_sets
from ridelake.schemas import CURATED, DATE_PARTS, NEIGHBORHOODS, RAW
from ridelake.session import use_zone
from ridelake.sources.compaction import compact, read_compacted
from ridelake.sources.driver_tables import (
    broken_events,
    closing_ride,
    delivered_twice,
    neighborhoods,
    rides,
    rides_by_user,
    untimed,
    with_new_fields,
)
from ridelake.sources.event_log import read_event_stream, read_events, write_events
from ridelake.sources.files import read_neighborhoods_csv, require_rides_csv
from ridelake.sources.history import KeyHistory
from ridelake.sources.lake import append_partitioned, overwrite_table, read_date_range, read_table
from ridelake.sources.layout import append_by_place, in_box
from ridelake.sources.workspace import new_folder, written
from ridelake.streaming.counts import counted, totals
from ridelake.streaming.fares import window_fares
from ridelake.streaming.landing import first_deliveries, land, read_raw_stream, with_lateness
from ridelake.streaming.late import run_window_fares, window_fares_now
from ridelake.streaming.replay import random_part, replay, replay_parts, time_part, time_slices
from ridelake.streaming.sinks import finish, start_append
from ridelake.streaming.state import pending_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the queries' SQL.
RANGE = ("2024-01-05 06:30:00", "2024-01-12 18:00:00")
PLACE_BOX = (40.5, 40.56, -74.2, -74.05)
PARTS = 10
TIME_PARTS = 3
# Rides of one micro-batch where a stream's state holds all of them until their time has passed.
SLICE_ROWS = 2_000_000
WRONG_DAY = "2024-01-09"
HISTORY_BUCKETS = 8
SET_BUCKETS = 3
COMPACT_BYTES = 32 << 10
PLACE_ROWS, PLACE_COLUMNS = 61, 67


def _plain(df: DataFrame) -> DataFrame:
    """Column types that tools show alike: NULL-able small numbers as doubles, times as UTC wall-clock time."""
    plain = {"float": "double", "tinyint": "double", "smallint": "double", "timestamp": "timestamp_ntz", "date": "string"}
    casts = {c: plain.get(t, "double" if t.startswith("decimal") else t) for c, t in df.dtypes}
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in casts.items()])


def _query(run: Query) -> Query:
    """Registers ``run`` under its name; it runs with the session in UTC and gives plain types."""

    def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(run(use_zone(spark), sf_dir))

    QUERIES[run.__name__] = registered
    return registered


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(to_events(rides(spark, sf_dir)))


def _regions(spark: SparkSession, sf_dir: str) -> Regions:
    return build_regions(neighborhoods(spark, sf_dir))


def _published_in_time_order(source: DataFrame, folder: str, slice_rows: int | None = None) -> Iterator[int]:
    """Adds the rides to the log, one span of time after the other, and at last a ride long after them.

    With ``slice_rows`` each span is one file or more of at most about so many rides, also in order of time.
    """
    events = to_events(source, keep=("pickup_datetime",))
    by, slices = time_part(source, TIME_PARTS), None
    if slice_rows is not None:
        by, slices = time_slices(source, TIME_PARTS, slice_rows)
    yield from replay_parts(events, f"{folder}/log", f"{folder}/staged", TIME_PARTS, by, slices=slices)
    write_events(to_events(closing_ride(source)), f"{folder}/log")
    yield TIME_PARTS


# --- rows ---------------------------------------------------------------------


@_query
def event_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides to events and back to typed raw rides."""
    return _raw(spark, sf_dir)


@_query
def bad_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and unreadable records of a log with broken and repeated events."""
    flagged = flag_bad_records(delivered_twice(broken_events(spark, sf_dir)), "text")
    return flagged.select("key", F.col("text").isNotNull().cast("int").alias("is_bad"), "fare_amount", "text")


@_query
def filter_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides with both pickup coordinates."""
    return with_coordinates(rides(spark, sf_dir)).select("key", "fare_amount", "pickup_latitude", "pickup_longitude")


@_query
def curate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated types of all rides, without duplicates, before any region is known."""
    raw = parse_events(delivered_twice(to_events(rides(spark, sf_dir))))
    return to_curated(raw.withColumn("pickup_region", F.lit(None).cast("string"))).drop("pickup_region")


@_query
def dedupe_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides delivered twice, each kept once."""
    return distinct_rows(delivered_twice(rides(spark, sf_dir)))


@_query
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and fares of each part of a fixed split."""
    parted = with_part(rides(spark, sf_dir), PARTS, F.col("key").cast("bigint"))
    return parted.groupBy("part").agg(F.count("*").alias("n"), F.max("fare_amount").alias("max_fare"))


@_query
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random split, made in one pass: its parts together hold every ride once."""
    parted = with_part(to_events(rides(spark, sf_dir)), PARTS, random_part(PARTS, seed=7))
    return parted.groupBy("key").agg(F.count_if(F.col("part").between(0, PARTS - 1)).alias("n"))


# --- joins and regions ----------------------------------------------------------


@_query
def region_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ride with the regions of its cluster."""
    assigned = assign_regions(rides(spark, sf_dir), _regions(spark, sf_dir))
    return assigned.select("key", "fare_amount", "pickup_datetime", "pickup_region")


@_query
def ride_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides per cluster; a cluster is named by its first neighbourhood, as its number means nothing."""
    places = neighborhoods(spark, sf_dir)
    model = fit_regions(places)
    names = label_neighborhoods(model, places).groupBy("cluster").agg(F.min("neighborhood").alias("first_region"))
    counts = assign_cluster(rides(spark, sf_dir), model, cluster="cluster").groupBy("cluster").agg(F.count("*").alias("n"))
    # One row per cluster on either side.
    return left_join_small(counts, names, "cluster").drop("cluster")


@_query
def nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides per nearest place, of up to some four thousand places that customers are laid out on; ties go to the first place."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    latitude = 40.46 + 0.003 * (F.col("c_custkey") % PLACE_ROWS)
    longitude = -74.25 + 0.006 * (F.col("c_custkey") % PLACE_COLUMNS)
    # As many places as there are rows times columns, whatever the number of customers.
    places = customers.select(latitude.alias("latitude"), longitude.alias("longitude")).distinct()
    centers = [tuple(row) for row in places.orderBy("latitude", "longitude").collect()]
    placed = with_nearest_of_many(rides(spark, sf_dir), "pickup_latitude", "pickup_longitude", centers, "place", BROADCAST_BYTES)
    return placed.groupBy("place").agg(F.count("*").alias("rides"))


@_query
def interval_reattach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a user's rides at most ten minutes apart."""
    left = rides_by_user(spark, sf_dir).select("key", "ride", "pickup_datetime")
    right = left.withColumnsRenamed(
        {"key": "near_key", "ride": "near_ride", "pickup_datetime": "near_time"}
    )
    return interval_left_join(left, right)


@_query
def region_reattach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rides of users, with the regions of all their rides within ten minutes."""
    raw = parse_events(to_events(rides_by_user(spark, sf_dir)))
    return curated(raw, _regions(spark, sf_dir), by_interval=True)


@_query
def curate_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rides, with the regions of their own pickup point, from a log with repeats."""
    raw = parse_events(delivered_twice(to_events(rides(spark, sf_dir))))
    return curated(raw, _regions(spark, sf_dir))


# --- fares ----------------------------------------------------------------------


@_query
def fare_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares per day."""
    return fares_by_day(_raw(spark, sf_dir))


@_query
def fare_by_day_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares per day and region of the curated rides."""
    return fares_of_raw(_raw(spark, sf_dir), _regions(spark, sf_dir))


@_query
def fare_by_day_region_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, summed per cluster before the fan-out to regions."""
    return fares_by_day_region_of(with_coordinates(rides(spark, sf_dir)), _regions(spark, sf_dir))


@_query
def rides_of_region_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides per day that lie in any neighbourhood of a set: those of a world region, and all that end in an odd digit."""
    path = new_folder(spark, "sets")
    raw = parse_events(to_events(rides_by_user(spark, sf_dir)))
    write_ride_sets(curated(raw, _regions(spark, sf_dir), by_interval=True), path, SET_BUCKETS)
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    world = nations.select(F.concat(F.lit("region "), "n_regionkey").alias("name"), F.col("n_name").alias("pickup_region"))
    odd = nations.filter("n_nationkey % 2 = 1").select(F.lit("odd").alias("name"), F.col("n_name").alias("pickup_region"))
    return rides_in_any(read_table(spark, path, T.StructType.fromDDL(SETS)), world.unionAll(odd), "name")


# --- tables ---------------------------------------------------------------------


@_query
def date_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time range of the raw table, read from the partitions it touches."""
    path = new_folder(spark, "range")
    append_partitioned(_raw(spark, sf_dir), path)
    return read_date_range(spark, path, *RANGE, schema=RAW)


@_query
def box_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of time and place, read from a table laid out by both."""
    path = new_folder(spark, "box")
    append_by_place(_raw(spark, sf_dir), path)
    return in_box(read_table(spark, path, RAW), *RANGE, *PLACE_BOX)


@_query
def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after the same rides were appended twice."""
    path = new_folder(spark, "append")
    for _ in range(2):
        append_partitioned(_raw(spark, sf_dir), path)
    return read_table(spark, path, RAW)


@_query
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after all rides were replaced by those with coordinates."""
    path = new_folder(spark, "overwrite")
    raw = _raw(spark, sf_dir)
    overwrite_table(raw, path, DATE_PARTS)
    overwrite_table(with_coordinates(raw), path, DATE_PARTS)
    return read_table(spark, path, RAW)


@_query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table of a raw table whose second append brought a new column."""
    folder = new_folder(spark, "evolution")
    raw, new = _raw(spark, sf_dir), T.StructField("fare_cents", T.DoubleType())
    append_partitioned(raw, f"{folder}/raw")
    append_partitioned(raw.withColumn("fare_cents", F.round(F.col("fare_amount").cast("double") * 100)), f"{folder}/raw")
    grown = read_table(spark, f"{folder}/raw", T.StructType([*RAW.fields, new]))
    curate(grown, neighborhoods(spark, sf_dir), f"{folder}/curated", more=["fare_cents"])
    rows = read_table(spark, f"{folder}/curated", T.StructType([*CURATED.fields, new]))
    return rows.select("key", "pickup_region", "fare_amount", "fare_cents")


@_query
def payload_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rides with two fields that the ride schema does not have, landed before they are known and after."""
    folder = new_folder(spark, "payload")
    source = with_new_fields(rides(spark, sf_dir)).withColumn("half", F.col("key").cast("bigint") % 2)
    events = to_events(source, keep=("half",), more=("surge", "tip"))
    fields = {}
    for half in replay_parts(events, f"{folder}/log", f"{folder}/staged", 2, F.col("half")):
        fields = new_fields(read_table(spark, f"{folder}/raw", raw_with())) if half else {}
        stream = read_event_stream(spark, f"{folder}/log")
        finish(land(stream, f"{folder}/raw", f"{folder}/checkpoint", available_now=True, keep_rest=True, fields=fields))
    raw = promoted(read_table(spark, f"{folder}/raw", raw_with(fields=fields)), fields)
    curate(raw, neighborhoods(spark, sf_dir), f"{folder}/curated", more=[*fields])
    grown = T.StructType([*CURATED.fields, *[f for f in raw_with(fields=fields) if f.name in fields]])
    rows = read_table(spark, f"{folder}/curated", grown)
    return rows.select("key", "pickup_region", "fare_amount", "surge", "tip")


@_query
def land_against_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides landed in three batches, the second one twice; later batches bring copies of earlier rides, moved on by twenty days."""
    folder = new_folder(spark, "history")
    source = rides(spark, sf_dir)
    first = source.withColumn("delivered", time_part(source, TIME_PARTS))
    again = first.filter(F.col("key").cast("bigint") % 20 == 0).withColumns(
        {
            "pickup_datetime": F.col("pickup_datetime") + F.expr("INTERVAL 20 DAYS"),
            "delivered": F.explode(F.sequence(F.col("delivered"), F.lit(TIME_PARTS))),
        }
    )
    events = to_events(first.unionAll(again), keep=("delivered",))
    history = KeyHistory(spark, f"{folder}/history", HISTORY_BUCKETS)
    for number in [0, 1, 1, 2, TIME_PARTS]:
        delivered = parse_events(events.filter(F.col("delivered") == number))
        land_batch(delivered, f"{folder}/raw", history, f"part-{number}")
    return read_landed(spark, f"{folder}/raw")


@_query
def curate_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table after a day with wrong rides was curated twice and then corrected."""
    folder = new_folder(spark, "rerun")
    # Each curation reads its rides and, besides, their days: the events are made and parsed once for all of them.
    raw, places = written(_raw(spark, sf_dir), "rerun-raw"), neighborhoods(spark, sf_dir)
    wrong = F.to_date("pickup_datetime") == WRONG_DAY
    moved = {
        "fare_amount": F.when(wrong, F.lit(-1.0)).otherwise(F.col("fare_amount")).cast("float"),
        "pickup_longitude": F.when(wrong, F.lit(-74.2)).otherwise(F.col("pickup_longitude")),
    }
    for rows in (raw.withColumns(moved), raw.withColumns(moved), raw.filter(wrong)):
        curate(rows, places, f"{folder}/curated", replace=True)
    return read_table(spark, f"{folder}/curated", CURATED)


@_query
def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides written as CSV, checked, and read with the fixed types."""
    path = new_folder(spark, "csv")
    rides(spark, sf_dir).write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return require_rides_csv(spark, path)


@_query
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published in random parts and read back."""
    folder = new_folder(spark, "log")
    events = to_events(rides(spark, sf_dir))
    replay(events, f"{folder}/log", f"{folder}/staged", PARTS, pause=0)
    return parse_events(read_events(spark, f"{folder}/log")).select("key", "fare_amount", "pickup_datetime")


@_query
def curate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table, written by date and region, and read back."""
    path = new_folder(spark, "curated")
    curate(_raw(spark, sf_dir), neighborhoods(spark, sf_dir), path)
    return read_table(spark, path, CURATED)


# --- streams, each run until its input is done ------------------------------------


@_query
def stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log, with broken and repeated events, landed as a stream in the raw table."""
    folder = new_folder(spark, "land")
    write_events(delivered_twice(broken_events(spark, sf_dir)), f"{folder}/log")
    stream = read_event_stream(spark, f"{folder}/log")
    finish(land(stream, f"{folder}/raw", f"{folder}/checkpoint", available_now=True))
    return read_table(spark, f"{folder}/raw", RAW)


@_query
def compacted_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table that a stream has landed in many files, compacted, with what the stream landed after that."""
    folder = new_folder(spark, "compacted")
    events = to_events(rides(spark, sf_dir))
    for number in replay_parts(events, f"{folder}/log", f"{folder}/staged", TIME_PARTS, F.xxhash64("key")):
        stream = read_event_stream(spark, f"{folder}/log", max_files=1)
        finish(land(stream, f"{folder}/raw", f"{folder}/checkpoint", available_now=True))
        if number == TIME_PARTS - 2:
            compact(spark, f"{folder}/raw", f"{folder}/versions", target_bytes=COMPACT_BYTES)
    return read_compacted(spark, f"{folder}/raw", f"{folder}/versions")


@_query
def stream_curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table curated as a stream."""
    folder = new_folder(spark, "curate")
    append_partitioned(_raw(spark, sf_dir), f"{folder}/raw")
    stream = read_raw_stream(spark, f"{folder}/raw")
    query = curate(
        stream, neighborhoods(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoint", available_now=True
    )
    finish(query)
    return read_table(spark, f"{folder}/out", CURATED)


@_query
def stream_window_fare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly fares per region, from events that arrive in time order; every window with a ride comes out."""
    folder = new_folder(spark, "window")
    regions = _regions(spark, sf_dir)
    for _ in _published_in_time_order(rides(spark, sf_dir), folder):
        raw = with_coordinates(parse_events(read_event_stream(spark, f"{folder}/log")))
        finish(start_append(window_fares(raw, regions), f"{folder}/out", f"{folder}/checkpoint", available_now=True))
    return spark.read.parquet(f"{folder}/out")


def _windows_with_late_rides(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, int]:
    """Hourly fares of rides of which every twentieth comes a part of time late; the counts of all runs."""
    source, regions = rides(spark, sf_dir), _regions(spark, sf_dir)
    moved = (F.col("key").cast("bigint") % 20 == 0).cast("int")
    delivered = source.withColumn("delivered", time_part(source, TIME_PARTS) + moved)
    last = closing_ride(source).withColumn("delivered", F.lit(TIME_PARTS))
    events = to_events(delivered.unionAll(last), keep=("delivered",))
    runs = []
    for _ in replay_parts(events, f"{folder}/late-log", f"{folder}/staged", TIME_PARTS + 1, F.col("delivered")):
        raw = with_coordinates(parse_events(read_event_stream(spark, f"{folder}/late-log")))
        runs.append(run_window_fares(raw, regions, f"{folder}/fares"))
    return {name: sum(run[name] for run in runs) for name in ("read", "late")}


@_query
def late_rows_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly fares per region, and how many of their rides came after their hour was closed."""
    folder = new_folder(spark, "late")
    _windows_with_late_rides(spark, sf_dir, folder)
    return window_fares_now(spark, f"{folder}/fares")


@_query
def conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides read, unreadable, late and written, counted as they passed: by a batch, a landing stream, and windows with late rides."""
    folder = new_folder(spark, "conservation")
    events = delivered_twice(broken_events(spark, sf_dir))
    read, wrote = Observation("read"), Observation("wrote")
    flagged = counted(flag_bad_records(events), read, "read", bad=F.col("bad_text").isNotNull())
    good = flagged.filter("bad_text is null").drop("bad_text")
    append_partitioned(counted(good, wrote, "written"), f"{folder}/batch")
    write_events(events, f"{folder}/log")
    stream = read_event_stream(spark, f"{folder}/log")
    query = land(stream, f"{folder}/raw", f"{folder}/checkpoint", available_now=True, counts="landing")
    finish(query)
    windows = _windows_with_late_rides(spark, sf_dir, folder)
    runs = {
        "batch": read.get | wrote.get | {"late": 0},
        "stream": totals(query, "landing") | totals(query, "landing_written") | {"late": 0},
        "windows": windows | {"bad": 0, "written": windows["read"] - windows["late"]},
    }
    names = ["read", "bad", "late", "written"]
    rows = [(run, *[counts[name] for name in names]) for run, counts in runs.items()]
    return spark.createDataFrame(rows, "run string, read bigint, bad bigint, late bigint, written bigint")


@_query
def pending_windows_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six-hour windows that a stream still holds open, read from its state: those of the last three days."""
    folder = new_folder(spark, "pending")
    regions = _regions(spark, sf_dir)
    write_events(to_events(rides(spark, sf_dir)), f"{folder}/log")
    raw = with_coordinates(parse_events(read_event_stream(spark, f"{folder}/log")))
    fares = window_fares(raw, regions, "6 hours", "3 days")
    finish(start_append(fares, f"{folder}/out", f"{folder}/checkpoint", available_now=True))
    return pending_windows(spark, f"{folder}/checkpoint", regions)


@_query
def stream_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides of which some are delivered again a part later; each lands once."""
    folder = new_folder(spark, "first")
    source = rides(spark, sf_dir)
    first = source.withColumn("delivered", time_part(source, TIME_PARTS))
    again = first.filter(F.col("key").cast("bigint") % 20 == 0).withColumn("delivered", F.col("delivered") + 1)
    events = to_events(first.unionAll(again), keep=("delivered",))
    for _ in replay_parts(events, f"{folder}/log", f"{folder}/staged", TIME_PARTS + 1, F.col("delivered")):
        # So long a delay that no copy is too late: only the state can tell that it is one.
        rows = first_deliveries(parse_events(read_event_stream(spark, f"{folder}/log")), "400 days")
        finish(start_append(rows, f"{folder}/out", f"{folder}/checkpoint", DATE_PARTS, available_now=True))
    return read_table(spark, f"{folder}/out", RAW).select("key", "fare_amount", "pickup_datetime")


@_query
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' rides joined as a stream with their rides that have coordinates, at most ten minutes apart."""
    folder = new_folder(spark, "interval")
    for _ in _published_in_time_order(rides_by_user(spark, sf_dir), folder):
        raw = with_lateness(parse_events(read_event_stream(spark, f"{folder}/log")))
        near = with_coordinates(raw).select(
            F.col("key").alias("near_key"),
            F.col("pickup_datetime").alias("near_time"),
            # A plain time: a stream may have one event time only.
            F.timestamp_micros(F.unix_micros("pickup_datetime")).alias("near_pickup"),
            F.col("fare_amount").alias("near_fare"),
        )
        rows = interval_left_join(raw.select("key", "pickup_datetime", "fare_amount"), near)
        finish(start_append(rows, f"{folder}/out", f"{folder}/checkpoint", available_now=True))
    return spark.read.parquet(f"{folder}/out").filter("key <> 'closing'")


@_query
def stream_reattach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' rides, some of them delivered twice or without a time, curated as a stream by the interval join."""
    folder = new_folder(spark, "reattach")
    source = delivered_twice(untimed(rides_by_user(spark, sf_dir), "ride"))
    # The state holds the rides of a micro-batch or two: a file at a time, however many rides there are.
    for _ in _published_in_time_order(source, folder, SLICE_ROWS):
        query = curate(
            parse_events(read_event_stream(spark, f"{folder}/log", max_files=1)),
            neighborhoods(spark, sf_dir),
            f"{folder}/out",
            f"{folder}/checkpoint",
            distinct=True,
            by_interval=True,
            available_now=True,
        )
        finish(query)
    return read_table(spark, f"{folder}/out", CURATED).filter("key <> 'closing'")


@_query
def replay_land_curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay, landing and curation in one run, with the neighbourhoods from CSV."""
    folder = new_folder(spark, "pipeline")
    neighborhoods(spark, sf_dir).select(*NEIGHBORHOODS.names).write.option("header", True).csv(f"{folder}/places")
    places = read_neighborhoods_csv(spark, f"{folder}/places")
    return run_pipeline(rides(spark, sf_dir), places, folder, parts=PARTS, pause=0)
