"""Counting rows as they pass: no second scan of what was read, and none of what was written."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def counted(rows: DataFrame, into: str | Observation, name: str = "rows", **conditions: Column) -> DataFrame:
    """The rows; whatever runs them counts them as ``name``, and those that meet each condition under its own name.

    A batch counts into an ``Observation``, whose ``get`` waits for the one action that is run; a stream under a name
    that ``totals`` is asked for. Rows that a lost task had passed on are not counted twice.
    """
    counts = [F.count(F.lit(1)).alias(name), *[F.count_if(when).alias(key) for key, when in conditions.items()]]
    return rows.observe(into, *counts)


def totals(query: StreamingQuery, name: str) -> dict[str, int]:
    """The counts of all micro-batches of a finished query's run; none if it had no batch.

    Spark keeps the last 99 progress reports unless ``spark.sql.streaming.numRecentProgressUpdates`` (one more) says
    otherwise; if there may have been more, this raises rather than count too few.
    """
    reports = query.recentProgress
    if len(reports) >= int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates")) - 1:
        raise ValueError("the run may have had more micro-batches than progress reports are kept")
    batches = {r["batchId"]: r["observedMetrics"][name].asDict() for r in reports if name in r["observedMetrics"]}
    found: dict[str, int] = {}
    for counts in batches.values():
        for key, n in counts.items():
            found[key] = found.get(key, 0) + n
    return found
