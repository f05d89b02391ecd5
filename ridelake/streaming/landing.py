"""Event streams into the raw table."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ridelake.functions.columns import spread
from ridelake.operators.events import parse_events
from ridelake.operators.payload import REST, promoted
from ridelake.schemas import DATE_PARTS, RAW
from ridelake.sources.lake import gathered, require_zone
from ridelake.streaming.counts import counted
from ridelake.streaming.sinks import start_append

BAD = "_corrupt"


def with_lateness(rides: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Marks the pickup time as event time that may be ``delay`` late."""
    return rides.withWatermark("pickup_datetime", delay)


def first_deliveries(rides: DataFrame, delay: str = "10 minutes", spread_over: int | None = None) -> DataFrame:
    """Drops a ride whose key came before, within ``delay``. Streams only.

    Rows with no key or no time cannot be told apart and all pass: each gets a key of its
    own. Rows later than ``delay`` are dropped, so feed it events roughly in time order.

    All rows of a key meet in one task. Where one ride may be delivered very often,
    ``spread_over`` drops its copies in that many tasks first, so that as many
    rows at most are left for the one; this keeps a second state.
    """
    known = F.col("key").isNotNull() & F.col("pickup_datetime").isNotNull()
    name = F.when(known, F.concat(F.lit("key "), "key")).otherwise(F.expr("uuid()"))
    named = with_lateness(rides, delay).withColumn("_delivery", name)
    if spread_over is not None:
        named = named.withColumn("_task", spread(rides, spread_over))
        named = named.dropDuplicatesWithinWatermark(["_delivery", "_task"]).drop("_task")
    return named.dropDuplicatesWithinWatermark(["_delivery"]).drop("_delivery")


def land(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    available_now: bool = False,
    every: str | None = None,
    first_only: bool = False,
    delay: str = "10 minutes",
    spread_over: int | None = None,
    files_per_day: int | None = None,
    keep_rest: bool = False,
    fields: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
    counts: str | None = None,
    zone: str = "UTC",
) -> StreamingQuery:
    """Starts landing an event stream in the raw table, partitioned by date.

    As it stands this keeps no state and moves no row between tasks, so each task
    writes a file for each day it holds. ``files_per_day`` bounds the files a
    micro-batch adds to a day, at the price of a shuffle. ``first_only`` drops repeated
    deliveries; ``delay`` and ``spread_over`` are those of ``first_deliveries``.

    ``keep_rest`` lands the fields that the ride schema does not have as well, in a VARIANT column ``rest``; ``fields`` of it
    become columns, under other ``names`` if given. A stream may be started again with more fields: read the grown table with
    ``raw_with`` and ``promoted``.

    With ``counts`` the run counts, as rows pass, those ``read``, ``bad`` (unreadable) and ``undated`` under that name, and those
    ``written`` under the name with ``_written`` added; see ``counts.totals``.
    """
    require_zone(events.sparkSession, zone)
    rides = parse_events(events, None if counts is None else BAD, REST if keep_rest else None)
    if counts is not None:
        bad, undated = F.col(BAD).isNotNull(), F.col("pickup_datetime").isNull()
        rides = counted(rides, counts, "read", bad=bad, undated=undated).drop(BAD)
    if fields:
        rides = promoted(rides, fields, names=names)
    if first_only:
        rides = first_deliveries(rides, delay, spread_over)
    if files_per_day is not None:
        rides = gathered(rides, DATE_PARTS, files_per_day)
    if counts is not None:
        rides = counted(rides, f"{counts}_written", "written")
    return start_append(rides, path, checkpoint, DATE_PARTS, fmt, available_now, every)


def read_raw_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    schema: T.StructType = RAW,
) -> DataFrame:
    """The raw table as a stream; give the ``schema`` of a table that has grown columns."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
