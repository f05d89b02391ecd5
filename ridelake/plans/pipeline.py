"""Replay, land and curate, one after the other, over a bounded set of rides."""

import uuid

from pyspark.sql import DataFrame

from ridelake.operators.events import to_events
from ridelake.operators.regions import CLUSTERS, SEED
from ridelake.plans.curation import curate
from ridelake.schemas import CURATED
from ridelake.sources.event_log import read_event_stream
from ridelake.sources.lake import read_table
from ridelake.streaming.landing import land, read_raw_stream
from ridelake.streaming.replay import replay
from ridelake.streaming.sinks import finish


def run_pipeline(
    rides: DataFrame,
    neighborhoods: DataFrame,
    root: str,
    *,
    parts: int = 10,
    pause: float = 1.0,
    k: int = CLUSTERS,
    seed: int = SEED,
    max_files: int | None = 1000,
    files_per_day: int | None = 1,
    files_per_region: int | None = 1,
    zone: str = "UTC",
) -> DataFrame:
    """Runs the whole flow under ``root`` and returns the curated table.

    Run again under the same ``root``, it adds the rides it is given then. A micro-batch reads
    ``max_files`` files at most and adds ``files_per_day`` files to a day of the raw table and
    ``files_per_region`` to a day and region of the curated one; None leaves them unbounded.
    """
    spark = rides.sparkSession
    log, raw, out = f"{root}/events", f"{root}/raw", f"{root}/curated"
    replay(to_events(rides), log, f"{root}/staged/{uuid.uuid4().hex}", parts, pause=pause)
    finish(
        land(
            read_event_stream(spark, log, max_files=max_files),
            raw,
            f"{root}/checkpoint_raw",
            available_now=True,
            files_per_day=files_per_day,
            zone=zone,
        )
    )
    finish(
        curate(
            read_raw_stream(spark, raw, max_files=max_files),
            neighborhoods,
            out,
            f"{root}/checkpoint_curated",
            k=k,
            seed=seed,
            available_now=True,
            files_per_region=files_per_region,
            zone=zone,
        )
    )
    return read_table(spark, out, CURATED)
