"""Starting and running append streams into partitioned tables."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    cols: list[str] | None = None,
    fmt: str = "parquet",
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Starts an append into a table partitioned by ``cols``.

    The file sink commits each micro-batch in its own log, so a batch that is run
    again after a failure adds nothing twice. Write to such a folder only from its
    stream. The query runs until stopped, as fast as it can or ``every`` so often
    (such as ``"1 second"``); with ``available_now`` it ends when all present input
    is done.
    """
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if cols:
        writer = writer.partitionBy(*cols)
    if fmt == "delta":
        writer = writer.option("mergeSchema", True)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.start(path)


def finish(query: StreamingQuery) -> None:
    """Waits for a bounded query; raises what made it fail."""
    query.awaitTermination()
