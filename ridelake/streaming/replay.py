"""Playing a bounded set of events into the event log."""

import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.operators.rows import with_part
from ridelake.schemas import EVENTS
from ridelake.sources.event_log import write_events
from ridelake.sources.lake import partitioned_for_write
from ridelake.sources.workspace import drop_folder

# One file whatever the session says, in row groups that several tasks can read.
ONE_FILE = {"maxRecordsPerFile": "0", "parquet.block.size": str(8 << 20)}


def random_part(parts: int, seed: int | None = None) -> Column:
    """A part drawn at random for each row."""
    drawn = F.rand() if seed is None else F.rand(seed)
    return (drawn * parts).cast("int")


def time_part(rides: DataFrame, parts: int, at: str = "pickup_datetime") -> Column:
    """The part of a row when the time range of ``rides`` is cut into equal spans; no time gives part 0."""
    micros = F.unix_micros(at)
    span = rides.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    if span["first"] is None:
        return F.lit(0)
    width = (span["last"] - span["first"]) // parts + 1
    return F.coalesce(F.floor((micros - span["first"]) / width).cast("int"), F.lit(0))


def time_slices(rides: DataFrame, parts: int, rows: int, at: str = "pickup_datetime") -> tuple[Column, int]:
    """Slices of about equal rows in order of time, at most ``rows`` in each, and how many make up one of ``parts`` parts; no time gives slice 0.

    Rows of one time are in one slice, however many they are.
    """
    micros = F.unix_micros(at)
    slices = max(1, -(-rides.count() // (parts * rows)))
    shares = [i / (parts * slices) for i in range(1, parts * slices)]
    bounds = rides.agg(F.percentile_approx(micros, F.array(*map(F.lit, shares))).alias("at")).first()["at"] if shares else []
    if not bounds:
        return F.lit(0), slices
    passed = F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= micros)
    return F.when(F.col(at).isNull(), 0).otherwise(F.size(passed)), slices


def write_parts(events: DataFrame, path: str, parts: int = 10, by: Column | None = None) -> None:
    """Writes all events once, in ``parts`` folders, gathered by part so that each has few files."""
    parted = with_part(events, parts, by).select(*EVENTS.names, "part")
    partitioned_for_write(parted, ["part"]).write.partitionBy("part").parquet(path)


def replay_parts(
    events: DataFrame,
    target: str,
    staging: str,
    parts: int = 10,
    by: Column | None = None,
    fmt: str = "parquet",
    slices: int | None = None,
    **options: str,
) -> Iterator[int]:
    """Publishes the events part by part, giving the caller each part's number once it is out.

    Parts are random unless ``by`` (an integer column) fixes them. The source is
    read once: a single write to the new folder ``staging`` holds all parts, and
    publishing one reads its folder only. Empty parts are skipped. The staging folder
    is deleted when all parts are out.

    With ``slices`` a part is that many slices, numbered by ``by`` through all parts. They are published one after the other, each
    as one file that tasks can share: a stream that takes one file at a time (``max_files=1``) keeps their order, and
    its micro-batches do not grow with a part.
    """
    each = 1 if slices is None else slices
    write_parts(events, staging, parts * each, random_part(parts * each) if by is None else by)
    staged = events.sparkSession.read.schema("key STRING, value STRING, part INT").parquet(staging)
    for number in range(parts):
        published = False
        for own in range(number * each, (number + 1) * each):
            rows = staged.filter(F.col("part") == own)
            if not rows.isEmpty():
                if slices is None:
                    write_events(rows, target, fmt, **options)
                else:
                    write_events(rows.coalesce(1), target, fmt, **ONE_FILE, **options)
                published = True
        if published:
            yield number
    drop_folder(events.sparkSession, staging)


def replay(
    events: DataFrame,
    target: str,
    staging: str,
    parts: int = 10,
    by: Column | None = None,
    pause: float = 1.0,
    fmt: str = "parquet",
    **options: str,
) -> int:
    """Publishes the events in ``parts`` batches, ``pause`` seconds apart; returns how many there were."""
    published = 0
    for _ in replay_parts(events, target, staging, parts, by, fmt, **options):
        published += 1
        time.sleep(pause)
    return published
