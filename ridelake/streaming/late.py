"""Windowed fares that are right in the end: late rides go to a side table, and the windows they belong to are recomputed.

A stream drops, without a word, the rides of windows that it has closed. Here rides pass a gate first, which knows how far
the windows of the run before have been closed: it keeps all rides in one table, those of closed windows marked as
``late``. The windows are fed from the others, so none is dropped. After each run the windows with late rides are
computed again from the whole table, and the days they lie in are replaced in a table of corrections.

Under a ``root`` folder lie ``rides`` (with ``late``, partitioned by it and by date), ``windows`` (as they were closed),
``corrections`` and the checkpoints. One run at a time; a run that failed is made good by the next.
"""

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.columns import date_parts
from ridelake.operators.regions import Regions
from ridelake.schemas import DATE_PARTS, RAW
from ridelake.sources.lake import replace_days, require_zone
from ridelake.sources.workspace import list_folder
from ridelake.streaming.counts import counted, totals
from ridelake.streaming.fares import window_fares, window_sums
from ridelake.streaming.sinks import finish, start_append

GATED = T.StructType([*RAW.fields, T.StructField("late", T.BooleanType())])
FARES = (
    "window_start timestamp, window_end timestamp, pickup_region string, rides bigint, fare_cents bigint, avg_fare double"
)
CORRECTED = f"{FARES}, late_rides bigint, late_in_window bigint, year smallint, month tinyint, day tinyint"


def watermark_of(spark: SparkSession, checkpoint: str) -> datetime | None:
    """How far a stopped query has closed its event time, or None if it has not run; read from the logs of its checkpoint."""
    found = []
    for log, field in (("offsets", "batchWatermarkMs"), ("commits", "nextBatchWatermarkMs")):
        try:
            lines = spark.read.text(f"{checkpoint}/{log}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(lines.agg(F.max(F.get_json_object("value", f"$.{field}").try_cast("bigint"))).first()[0])
    closed = max((ms for ms in found if ms is not None), default=None)
    return None if closed is None else datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=closed)


def _window(width: str):
    return F.window("pickup_datetime", width)


def run_window_fares(
    rides: DataFrame, regions: Regions, root: str, width: str = "1 hour", delay: str = "10 minutes", zone: str = "UTC"
) -> dict[str, int]:
    """Takes in all rides that a stream of raw rides has now, and closes and corrects windows; gives how many were ``read`` and ``late``.

    All rides that pass the gate in a run are one micro-batch of the windows; bound a run by what the stream has.
    ``root``, ``width`` and ``delay`` stay the same from run to run.
    """
    spark = rides.sparkSession
    require_zone(spark, zone)
    closed = watermark_of(spark, f"{root}/checkpoint_windows")
    late = F.lit(False) if closed is None else _window(width).end <= F.lit(closed)
    # A ride without a time is in no window and never late.
    timed = rides.filter("pickup_datetime is not null").withColumn("late", late)
    gated = timed.unionByName(rides.filter("pickup_datetime is null").withColumn("late", F.lit(False)))
    parts = ["late", *DATE_PARTS]
    gated = counted(gated.select(*GATED.names), "gate", "read", late=F.col("late"))
    gate = start_append(gated, f"{root}/rides", f"{root}/checkpoint_rides", parts, available_now=True)
    finish(gate)
    on_time = spark.readStream.schema(GATED).parquet(f"{root}/rides").filter("not late").drop("late")
    fares = window_fares(on_time, regions, width, delay)
    finish(start_append(fares, f"{root}/windows", f"{root}/checkpoint_windows", available_now=True))
    _correct(spark, regions, root, width)
    return {"read": 0, "late": 0} | totals(gate, "gate")


def gated_rides(spark: SparkSession, root: str) -> DataFrame:
    """All rides taken in, with ``late``."""
    return spark.read.schema(GATED).parquet(f"{root}/rides")


def late_rides(spark: SparkSession, root: str) -> DataFrame:
    """The side table: rides that came after their window had been closed. Reads the files of such rides only."""
    return gated_rides(spark, root).filter("late").drop("late")


def _corrections(spark: SparkSession, root: str) -> DataFrame:
    if not list_folder(spark, f"{root}/corrections"):
        return spark.createDataFrame([], CORRECTED)
    return spark.read.schema(CORRECTED).parquet(f"{root}/corrections")


def _correct(spark: SparkSession, regions: Regions, root: str, width: str) -> None:
    """Recomputes the windows of all days in which a window has other late rides than its correction knows of."""
    late = late_rides(spark, root).groupBy(_window(width).start.alias("window_start")).agg(F.count("*").alias("late_in_window"))
    late = late.withColumns(date_parts("window_start"))
    known = _corrections(spark, root).select("window_start", F.col("late_in_window").alias("_known")).distinct()
    stale = late.join(known, "window_start", "left").filter(~F.col("late_in_window").eqNullSafe(F.col("_known")))
    days = stale.select(*DATE_PARTS).distinct().collect()
    if not days:
        return
    days = spark.createDataFrame([tuple(day) for day in days], T.StructType([RAW[name] for name in DATE_PARTS]))
    windows = late.join(F.broadcast(days), DATE_PARTS, "left_semi")
    touched = gated_rides(spark, root).withColumn("window_start", _window(width).start)
    touched = touched.join(windows.select("window_start"), "window_start", "left_semi").drop("window_start")
    late_count = F.count_if("late").alias("late_rides")
    rows = window_sums(touched, regions, width, late_count).join(windows, "window_start")
    replace_days(rows.select(*_corrections(spark, root).columns), f"{root}/corrections", days)


def window_fares_now(spark: SparkSession, root: str) -> DataFrame:
    """Fares of all closed windows, late rides included, with ``late_rides``, the number of these among a row's rides."""
    corrected = _corrections(spark, root)
    fares = T.StructType.fromDDL(FARES)
    closed = spark.read.schema(fares).parquet(f"{root}/windows")
    as_closed = closed.join(corrected.select("window_start").distinct(), "window_start", "left_anti")
    names = [*fares.names, "late_rides"]
    return as_closed.withColumn("late_rides", F.lit(0).cast("bigint")).select(*names).unionAll(corrected.select(*names))
