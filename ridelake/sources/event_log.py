"""The event log: a directory of ``(key, value)`` Parquet files, or a Kafka topic.

Kafka takes the same calls with ``fmt="kafka"`` and its own options (such as
``kafka.bootstrap.servers``); its connector is not installed here, so that path
is not tested.
"""

from pyspark.sql import DataFrame, SparkSession

from ridelake.operators.events import event_columns
from ridelake.schemas import EVENTS


def write_events(events: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Publishes ``(key, value)`` events: appends to the directory or topic ``target``."""
    writer = event_columns(events).write.format(fmt).mode("append").options(**options)
    if fmt == "kafka":
        writer.option("topic", target).save()
    else:
        writer.save(target)


def read_events(spark: SparkSession, source: str) -> DataFrame:
    """The events in a directory, as a batch frame."""
    return event_columns(spark.read.schema(EVENTS).option("recursiveFileLookup", True).parquet(source))


def read_event_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    starting: str = "earliest",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """The events as a stream, from the first one on.

    ``max_files`` bounds a micro-batch of a directory; for a topic pass
    ``maxOffsetsPerTrigger``. A topic whose old offsets are gone does not stop the
    stream.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        topic = {"subscribe": source, "startingOffsets": starting, "failOnDataLoss": "false"}
        return reader.options(**{**topic, **options}).load()
    if starting != "earliest":
        raise ValueError("a directory is always read from its first file on")
    # Replayed parts lie in part=N folders; the part is not a column of an event.
    reader = reader.schema(EVENTS).option("recursiveFileLookup", True).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(source)
