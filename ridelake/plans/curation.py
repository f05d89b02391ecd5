"""Raw rides to the curated table."""

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridelake.functions.columns import narrowed
from ridelake.operators.joins import interval_left_join, reattach, reattach_stream
from ridelake.operators.regions import (
    CLUSTERS,
    SEED,
    Regions,
    assign_cluster,
    attach_regions,
    build_regions,
    load_or_build_regions,
)
from ridelake.operators.rows import distinct_rows, with_coordinates
from ridelake.schemas import CURATED, DATE_PARTS, RAW, REGION_PARTS
from ridelake.sources.lake import append_partitioned, gathered, partitioned_for_write, replace_days, require_zone
from ridelake.streaming.landing import with_lateness
from ridelake.streaming.sinks import start_append

CLUSTER_PARTS = [*DATE_PARTS, "pickup_cluster"]
SLOT = "_slot"
# Tasks that write one day and cluster of a re-attached stream's micro-batch; the number of files does not follow the state's partitions.
REATTACHED_TASKS = 4
NEAR = {"key": "near_key", "pickup_datetime": "near_time"}


def to_curated(rides: DataFrame, distinct: bool = True, more: Sequence[str] = ()) -> DataFrame:
    """Rides with regions in the curated types, optionally without exact duplicates; ``more`` columns stay as they are."""
    typed = rides.select(*narrowed(CURATED), *more)
    return distinct_rows(typed) if distinct else typed


def _typed(rides: DataFrame, *more: str) -> DataFrame:
    return rides.select(*narrowed(CURATED, RAW.names), *more)


def _enriched(rides: DataFrame, regions: Regions, distinct: bool, delay: str, more: Sequence[str]) -> DataFrame:
    """Each ride with the cluster of its own pickup point."""
    typed = _typed(assign_cluster(rides, regions.model, "keep"), *more, "pickup_cluster")
    if not distinct:
        return typed
    return distinct_rows(with_lateness(typed, delay) if rides.isStreaming else typed)


def _reattached(
    rides: DataFrame, regions: Regions, distinct: bool, minutes: int, delay: str, more: Sequence[str], spread_over: int
) -> DataFrame:
    """Each ride with the clusters of all rides of its key within ``minutes``; a distinct stream's also with their time slot."""
    assigned = assign_cluster(rides, regions.model, "skip").select("key", "pickup_datetime", "pickup_cluster")
    typed = _typed(rides, *more)
    if not rides.isStreaming:
        if distinct:
            return reattach(distinct_rows(typed), assigned, "pickup_cluster", minutes=minutes)
        return interval_left_join(typed, assigned.withColumnsRenamed(NEAR), minutes=minutes)
    # A ride without a time meets none. The join would keep it until the watermark has passed a time it
    # does not have, so it goes around.
    timed = F.col("pickup_datetime").isNotNull()
    untimed = typed.filter(~timed).withColumn("pickup_cluster", F.lit(None).cast("int"))
    typed, assigned = with_lateness(typed.filter(timed), delay), with_lateness(assigned.filter(timed), delay)
    if not distinct:
        met = interval_left_join(typed, assigned.withColumnsRenamed(NEAR), minutes=minutes)
        return met.unionByName(untimed)
    met = reattach_stream(typed, assigned, "pickup_cluster", minutes=minutes, slot=SLOT, spread_over=spread_over)
    return met.unionByName(distinct_rows(untimed), allowMissingColumns=True)


def clustered_rides(
    raw: DataFrame,
    regions: Regions,
    distinct: bool | None = None,
    by_interval: bool = False,
    minutes: int = 10,
    delay: str = "10 minutes",
    more: Sequence[str] = (),
    spread_over: int = 1,
) -> DataFrame:
    """Curated rides before the fan-out: with the cluster whose regions they will get."""
    distinct = not raw.isStreaming if distinct is None else distinct
    kept = with_coordinates(raw)
    if by_interval:
        return _reattached(kept, regions, distinct, minutes, delay, more, spread_over)
    return _enriched(kept, regions, distinct, delay, more)


def curated(
    raw: DataFrame,
    regions: Regions,
    distinct: bool | None = None,
    by_interval: bool = False,
    minutes: int = 10,
    before_fan_out: Callable[[DataFrame], DataFrame] | None = None,
    delay: str = "10 minutes",
    more: Sequence[str] = (),
    spread_over: int = 1,
) -> DataFrame:
    """The curated rows of raw rides, batch or stream: one row per ride and region.

    Rides without pickup coordinates are left out. By default a ride gets the
    regions of its own pickup point; ``by_interval`` gives it those of every ride
    with its key at most ``minutes`` away, which differs only where keys repeat.

    ``distinct`` (default: on for batch, off for streams, where it would drop late
    rides) removes exact duplicates. They are removed before the fan-out, on the
    final types, and again after it only if two clusters share a region.
    ``delay`` is how late a stream's rides may be for that and for the interval.

    With ``by_interval`` no pair of rides is formed where they are distinct; only what keeps duplicates forms every
    pair of a key's rides in reach of each other. ``spread_over`` deals a key's rides of one time slot to so many tasks of a distinct stream.

    ``before_fan_out`` may lay the rides, with date parts and ``pickup_cluster``,
    out for a write while there are still few of them. ``more`` names columns that the raw
    table has grown and that the curated one is to have.
    """
    distinct = not raw.isStreaming if distinct is None else distinct
    clustered = clustered_rides(raw, regions, distinct, by_interval, minutes, delay, more, spread_over)
    if before_fan_out is not None:
        clustered = before_fan_out(clustered)
    # The slot is the event time of what a stream has re-attached: the state of the distinct below needs it.
    slot = [SLOT] if SLOT in clustered.columns else []
    rows = attach_regions(clustered, regions).select(*CURATED.names, *more, *slot)
    return (distinct_rows(rows) if distinct and not regions.separate else rows).drop(SLOT)


def curate(
    raw: DataFrame,
    neighborhoods: DataFrame,
    path: str,
    checkpoint: str | None = None,
    *,
    k: int = CLUSTERS,
    seed: int = SEED,
    distinct: bool | None = None,
    by_interval: bool = False,
    minutes: int = 10,
    delay: str = "10 minutes",
    more: Sequence[str] = (),
    fmt: str = "parquet",
    available_now: bool = False,
    every: str | None = None,
    files_per_region: int | None = None,
    spread_over: int = 1,
    replace: bool = False,
    days: DataFrame | None = None,
    zone: str = "UTC",
) -> StreamingQuery | None:
    """Writes the curated table, partitioned by date and region.

    A batch frame is appended and None returned. With ``replace`` it becomes all that the table holds of its ``days``
    (default: those of its rows), so a batch can be run again; give all raw rides of those days, and with ``by_interval`` those around
    midnight are told from these alone. Without ``days`` the rides are read twice, first for their date parts: give a table's
    rides, not some that are parsed as they are read. A stream is started and its query
    returned; its regions are fitted once, kept beside the checkpoint, and used
    again on restart. ``every`` is its trigger; ``files_per_region`` bounds the files a
    micro-batch adds to one day and region, at the price of a shuffle. A distinct stream with ``by_interval`` is always so bounded
    (default: ``REATTACHED_TASKS``): its joins deal each day and region to all their tasks, and each would write its own file. ``distinct``,
    ``by_interval``, ``minutes``, ``delay``, ``more`` and ``spread_over`` are those of ``curated``.

    Rides are gathered by day and cluster, before the fan-out: their regions' rows
    are then made in the task that writes them and are never shuffled.
    """
    require_zone(raw.sparkSession, zone)
    if not raw.isStreaming:
        regions = build_regions(neighborhoods, k, seed)
        rows = curated(
            raw,
            regions,
            distinct,
            by_interval,
            minutes,
            before_fan_out=lambda rides: partitioned_for_write(rides, CLUSTER_PARTS) if regions.separate else rides,
            more=more,
        )
        if replace:
            touched = raw.select(*DATE_PARTS) if days is None else days
            replace_days(rows, path, touched, REGION_PARTS, rebalance=not regions.separate)
        else:
            append_partitioned(rows, path, REGION_PARTS, fmt, rebalance=not regions.separate)
        return None
    if replace:
        raise ValueError("a stream appends; only a batch replaces days")
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    regions = load_or_build_regions(neighborhoods, f"{checkpoint.rstrip('/')}_regions", k, seed)
    layout = None
    if files_per_region is None and distinct and by_interval:
        files_per_region = REATTACHED_TASKS
    if files_per_region is not None:
        layout = partial(gathered, cols=CLUSTER_PARTS, tasks=files_per_region)
    rows = curated(raw, regions, distinct, by_interval, minutes, layout, delay, more, spread_over)
    return start_append(rows, path, checkpoint, REGION_PARTS, fmt, available_now, every)
