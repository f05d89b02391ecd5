"""The keys of all landed rides, kept so that a batch can be compared with them without moving them.

Keys lie in Parquet files bucketed and sorted by key. A batch is dealt to the same buckets and merged with them: the
batch is shuffled, the history never, however long it has grown. The table is known by its folder. A session without a lasting catalog
registers it anew, with the bucket count that is written beside it.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.sources.workspace import drop_folder, list_folder

BUCKETS = 64
BATCH = re.compile(r"[A-Za-z0-9_.-]+")
SETTLED = "settled"


class KeyHistory:
    """Which batch brought each key, in the folder ``path``.

    ``buckets`` counts for a new history only; choose it so that a bucket's keys fit a task. Every batch adds a file
    to each bucket it has keys for; ``compacted`` makes one file of a bucket's files. Batches are named by
    letters, digits, dots, dashes and underscores.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._agreed(buckets)
        self.name = f"ridelake_keys_{hashlib.md5(self.path.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (key STRING, batch STRING) USING parquet PARTITIONED BY (batch)"
            f" CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self._quoted()}/keys'"
        )
        if list_folder(spark, f"{self.path}/keys"):
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def _quoted(self) -> str:
        return self.path.replace("\\", "\\\\").replace("'", "\\'")

    def _agreed(self, buckets: int) -> int:
        facts = f"{self.path}/facts"
        try:
            return self.spark.read.schema("buckets INT").parquet(facts).first()["buckets"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        self.spark.createDataFrame([(buckets,)], "buckets INT").coalesce(1).write.parquet(facts)
        return buckets

    def keys(self) -> DataFrame:
        """All ``(key, batch)``."""
        return self.spark.table(self.name)

    def unseen(self, rides: DataFrame, batch: str | None = None) -> DataFrame:
        """Rides, batch or stream, whose key no other batch has brought; rides without a key all are.

        Keys of the ``batch`` itself do not count, so that it gives the same rides when it is run again.
        A stream sees the history as it is when the stream starts.
        """
        past = self.keys() if batch is None else self.keys().filter(F.col("batch") != batch)
        # Rides without a key match nothing; dealt by the whole row they are no hot bucket.
        dealt = rides.withColumn("_dealt", F.coalesce("key", F.xxhash64(*_comparable(rides)).cast("string")))
        dealt = dealt.repartition(self.buckets, "_dealt")
        seen = past.select(F.col("key").alias("_seen")).hint("merge")
        met = (F.col("_dealt") == F.col("_seen")) & F.col("key").isNotNull()
        # Not an anti-join: that would be made before the dealing, and might shuffle both sides anew.
        return dealt.join(seen, met, "left").filter(F.col("_seen").isNull()).select(*rides.columns)

    def put(self, rides: DataFrame, batch: str) -> None:
        """Makes the keys of the rides all that the history has of a batch."""
        if not BATCH.fullmatch(batch):
            raise ValueError(f"a batch is named by letters, digits, dots, dashes and underscores, not {batch!r}")
        keys = rides.filter(F.col("key").isNotNull()).select("key").distinct()
        dealt = keys.repartition(self.buckets, "key").sortWithinPartitions("key")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{batch}') SELECT key FROM {{dealt}}", dealt=dealt)

    def compacted(self, path: str, buckets: int | None = None) -> KeyHistory:
        """The same keys in another folder, once each and in one file a bucket; perhaps in more buckets.

        They all belong to the batch ``settled`` there, so none of the batches they came with can be run again.
        """
        other = KeyHistory(self.spark, path, buckets or self.buckets)
        other.put(self.keys(), SETTLED)
        return other

    def drop(self) -> None:
        """Deletes the history."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_folder(self.spark, self.path)


def _comparable(rides: DataFrame) -> list[Column]:
    """All columns, VARIANT ones as text."""
    return [F.col(name).cast("string").alias(name) if dtype == "variant" else F.col(name) for name, dtype in rides.dtypes]


def first_of_each(rides: DataFrame) -> DataFrame:
    """One ride of every key: the earliest, of equal times the one with the least values. Batch only.

    Rides without a key or a time cannot be told apart and all stay. Copies are reduced in the map tasks, so a
    ride that was delivered very often is one row a task when it is shuffled, of whichever kind it is.
    """
    known = F.col("key").isNotNull() & F.col("pickup_datetime").isNotNull()
    own = F.when(~known, F.struct(F.spark_partition_id().alias("_task"), *_comparable(rides)))
    order = F.struct("pickup_datetime", *_comparable(rides))
    groups = rides.withColumn("_own", own).groupBy("key", "_own")
    first = groups.agg(F.min_by(F.struct(*rides.columns), order).alias("_ride"), F.count("*").alias("_n"))
    copies = F.when(F.col("_own").isNull(), F.lit(1)).otherwise(F.col("_n"))
    return first.select("_ride", F.explode(F.sequence(F.lit(1), copies))).select("_ride.*")
