"""Few large files instead of many small ones, as versions of a table of which readers take the latest.

Streams leave a file a task and day. ``compact`` writes all rows of a table anew, and readers go over to the new version once it is
complete; the table itself is left as it is, so a stream may go on writing to it. What it adds later is read
beside the version until the next one.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.joins import left_join_salted, left_join_small
from ridelake.schemas import DATE_PARTS, RAW
from ridelake.sources.workspace import drop_folder, list_folder

TARGET_BYTES = 128 << 20
BROADCAST_FILES = 100_000


def _laid_out(table: DataFrame, cols: list[str], target_bytes: int) -> DataFrame:
    """Rows with ``part``, so that every part of a partition holds about the target's bytes.

    The files of a partition lie one after the other on a line of bytes, a file's rows evenly along it; the line is cut into equal
    parts. So small files are put together, large ones are cut, and rows that lay together stay so.
    """
    read = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = table.groupBy(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes"), *cols)
    files = files.agg(F.count("*").alias("_rows"))
    # One row a file of the partition.
    along = Window.partitionBy(*cols).orderBy("_file")
    whole = F.sum("_bytes").over(Window.partitionBy(*cols))
    parts = F.greatest(F.round(whole / target_bytes), F.lit(1.0))
    facts = files.select("_file", "_bytes", "_rows", (F.sum("_bytes").over(along) - F.col("_bytes")).alias("_start"), parts.alias("_parts"), (whole / parts).alias("_width"))
    join = left_join_small if files.count() <= BROADCAST_FILES else left_join_salted
    place = F.col("_start") + F.col("_bytes") * (F.col("_row") + 0.5) / F.col("_rows")
    part = F.least(F.floor(place / F.col("_width")), F.col("_parts") - 1).cast("int")
    return join(read, facts, "_file").withColumn("part", part).select(*table.columns, "part")


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The complete ones."""
    numbers = [int(name[1:]) for name in list_folder(spark, root) if name[:1] == "v" and name[1:].isdigit()]
    return sorted(n for n in numbers if "_SUCCESS" in list_folder(spark, f"{root}/v{n}"))


def compact(
    spark: SparkSession,
    source: str,
    root: str,
    schema: T.StructType = RAW,
    cols: list[str] = DATE_PARTS,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Writes the rows that the table ``source`` has now as the next version under ``root`` and gives its number.

    A partition has one file for each ``target_bytes`` of its files, one at least. A run that fails leaves an incomplete version, which nobody
    reads and the next run writes over. One run at a time.
    """
    table = spark.read.schema(schema).parquet(source)
    version = max(_versions(spark, root), default=0) + 1
    covered = spark.createDataFrame([(path,) for path in table.inputFiles()], "path string")
    covered.write.mode("overwrite").parquet(f"{root}/files{version}")
    rows = _laid_out(table, cols, target_bytes).repartition(*cols, "part")
    rows.write.mode("overwrite").partitionBy(*cols, "part").parquet(f"{root}/v{version}")
    return version


def read_compacted(spark: SparkSession, source: str, root: str, schema: T.StructType = RAW) -> DataFrame:
    """All rows of the table: those of the latest version, and of the files that have come since; of the table alone if there is no version."""
    table = spark.read.schema(schema).parquet(source)
    version = max(_versions(spark, root), default=None)
    if version is None:
        return table.select(*schema.names)
    covered = {row["path"] for row in spark.read.schema("path string").parquet(f"{root}/files{version}").collect()}
    later = [path for path in table.inputFiles() if path not in covered]
    rows = spark.read.schema(schema).parquet(f"{root}/v{version}").select(*schema.names)
    if later:
        rows = rows.unionAll(spark.read.schema(schema).option("basePath", source).parquet(*later).select(*schema.names))
    return rows


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Deletes all but the latest ``keep`` versions; give readers of older ones time to end."""
    for version in _versions(spark, root)[: -keep or None]:
        drop_folder(spark, f"{root}/v{version}")
        drop_folder(spark, f"{root}/files{version}")
