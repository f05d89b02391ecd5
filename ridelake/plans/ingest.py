"""Landing in batches: each ride once over all batches there ever were, and each batch as often as one likes."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridelake.schemas import DATE_PARTS, RAW
from ridelake.sources.history import KeyHistory, first_of_each
from ridelake.sources.lake import overwrite_table, require_zone


def land_batch(raw: DataFrame, path: str, history: KeyHistory, batch: str, zone: str = "UTC") -> None:
    """Lands raw rides whose key no other batch has landed, however long ago, as the ``batch`` of the table.

    Of several rides of a key the earliest is landed; rides without a key or a time all are. The rides replace what
    the table has of the batch, and then their keys what the history has of it. So after a failure at any
    point, or with corrected input, the batch may be run again, as long as no later batch has been landed meanwhile. One
    batch runs at a time.
    """
    require_zone(raw.sparkSession, zone)
    folder = _folder(path, batch)
    overwrite_table(history.unseen(first_of_each(raw), batch), folder, DATE_PARTS)
    history.put(raw.sparkSession.read.schema(raw.schema).parquet(folder), batch)


def read_landed(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """The raw table of all batches, without their names; date ranges prune its partitions as ever."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _folder(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/batch={batch}"
