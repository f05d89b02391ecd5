"""Lake tables: partitioned appends, overwrites, reads, and date-range reads.

``fmt`` is ``parquet`` by default. ``delta`` uses the same calls where that
package is on the class path; it is not tested here.
"""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.columns import spread
from ridelake.schemas import DATE_PARTS
from ridelake.sources.workspace import drop_folder, list_folder, move_folder

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def require_zone(spark: SparkSession, zone: str = "UTC") -> None:
    """Raises unless the session works in ``zone``, on which all date partitions depend."""
    session = spark.conf.get("spark.sql.session.timeZone")
    if session != zone and not {session, zone} <= UTC_NAMES:
        raise ValueError(f"session time zone is {session}, the lake is kept in {zone}")


def partitioned_for_write(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows grouped by the partition columns, so that a table partition gets few files.

    The rebalance hint lets the adaptive planner split a partition that holds far
    more than its share and merge small ones; a plain repartition would send a hot
    date to one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols])


def gathered(df: DataFrame, cols: list[str], tasks: int) -> DataFrame:
    """Rows of equal ``cols`` brought together in at most ``tasks`` tasks: a bound on files for streams, adaptive or not."""
    return df.withColumn("_task", spread(df, tasks)).repartition(*cols, "_task").drop("_task")


def append_partitioned(
    df: DataFrame, path: str, cols: list[str] = DATE_PARTS, fmt: str = "parquet", rebalance: bool = True
) -> None:
    """Appends to a table partitioned by ``cols``. New columns become part of the table.

    ``rebalance=False`` saves the shuffle where each task already holds few dates.
    """
    rows = partitioned_for_write(df, cols) if rebalance else df
    writer = rows.write.format(fmt).mode("append").partitionBy(*cols)
    if fmt == "delta":
        writer = writer.option("mergeSchema", True)
    writer.save(path)


def overwrite_table(df: DataFrame, path: str, cols: list[str] | None = None, fmt: str = "parquet") -> None:
    """Replaces a table."""
    rows = partitioned_for_write(df, cols) if cols else df
    rows.write.format(fmt).mode("overwrite").partitionBy(*(cols or [])).save(path)


HIDDEN = "_replacing"


def replace_days(
    rows: DataFrame, path: str, days: DataFrame, cols: list[str] = DATE_PARTS, rebalance: bool = True
) -> None:
    """Makes ``rows`` all that the table under ``path`` holds of the ``days`` (``year``, ``month``, ``day``); other days keep their files.

    Run again, it gives the same table, so a batch may be repeated after a failure or with corrected input. ``cols`` begin with the
    date parts. Partitions that a day no longer has go, and a day without rows goes as a whole; rows of a day that is
    not named are refused.

    All rows are written beside the table first, in a folder that readers do not see. Then the days are swapped one
    by one, a deletion and a renaming each; ``days`` goes through the driver, one row a day. A reader may miss a day while it is
    swapped, and one such call runs at a time. Parquet tables that no stream writes to.
    """
    spark = rows.sparkSession
    if cols[: len(DATE_PARTS)] != DATE_PARTS:
        raise ValueError(f"the table must be partitioned by {DATE_PARTS} first")
    named = {tuple(day) for day in days.select(*DATE_PARTS).distinct().collect()}
    staged = f"{path.rstrip('/')}/{HIDDEN}"
    drop_folder(spark, staged)
    kept = partitioned_for_write(rows, cols) if rebalance else rows
    kept.write.partitionBy(*cols).parquet(staged)
    strange = _folders(spark, staged, len(DATE_PARTS)) - {_day_folder(day) for day in named}
    if strange:
        drop_folder(spark, staged)
        raise ValueError(f"rows of days that are not to be replaced: {sorted(strange)[:5]}")
    for day in sorted(map(_day_folder, named)):
        drop_folder(spark, f"{path.rstrip('/')}/{day}")
        move_folder(spark, f"{staged}/{day}", f"{path.rstrip('/')}/{day}")
    drop_folder(spark, staged)


def _day_folder(day: tuple) -> str:
    none = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{name}={none if value is None else value}" for name, value in zip(DATE_PARTS, day))


def _folders(spark: SparkSession, path: str, depth: int) -> set[str]:
    """The partition folders ``depth`` levels under a table's."""
    found = {""}
    for _ in range(depth):
        found = {f"{f}/{name}".lstrip("/") for f in found for name in list_folder(spark, f"{path}/{f}") if "=" in name}
    return found


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """A lake table. Pass ``schema`` to keep the narrow types of the partition columns.

    ``merge_schema`` reads the columns of all files, for tables that have grown columns.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def _bound(value: str | datetime) -> datetime:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is not None:
        raise ValueError("give the range without an offset, in the zone of the lake")
    return moment


def in_date_range(
    table: DataFrame, start: str | datetime, end: str | datetime, time: str = "pickup_datetime", zone: str = "UTC"
) -> DataFrame:
    """Rows with ``start <= time < end``, reading only the date partitions the range touches.

    Spark cannot tell that ``year/month/day`` follow from the time, so the range is
    also stated on them.
    """
    require_zone(table.sparkSession, zone)
    first, stop = _bound(start), _bound(end)
    last = stop - timedelta(microseconds=1)
    date_number = F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    partitions = F.col("year").between(first.year, last.year) & date_number.between(
        first.year * 10000 + first.month * 100 + first.day, last.year * 10000 + last.month * 100 + last.day
    )
    since = F.lit(first.isoformat(sep=" ")).cast("timestamp")
    until = F.lit(stop.isoformat(sep=" ")).cast("timestamp")
    return table.filter(partitions & (F.col(time) >= since) & (F.col(time) < until))


def read_date_range(
    spark: SparkSession,
    path: str,
    start: str | datetime,
    end: str | datetime,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    zone: str = "UTC",
) -> DataFrame:
    """``in_date_range`` over a lake table."""
    return in_date_range(read_table(spark, path, schema, fmt), start, end, zone=zone)
