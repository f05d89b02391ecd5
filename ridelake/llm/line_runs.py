"""Line deduplication over levelled sorted runs of line hashes (Spark functions only).

A run is a table of ``(key, n)`` sorted by ``key``: a line's 64-bit hash and the
documents found to hold it. Every batch of documents becomes a run of level 0: its
counts are merge-anti-joined against the runs, which removes lines already known to
be common, and what is left is added. Once a level has ``fanout`` runs they are merged into one
run of the next level, so a store of n batches keeps about log(n) runs.

Two lines are taken as equal when their hashes are. At 10**11 different lines a given
common line meets one wrong partner with a chance of about 5 in 10**9.

Nulls and empty texts are one empty line. Empty lines are never dropped. Repeated
rows count as documents of their own and get the same result. An empty table gives
an empty run and an empty result. Columns of any name stay as they are.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm.rows import BLANKS, lower_ascii
from ridelake.sources.workspace import drop_folder, new_folder, written

RUN = "key long, n long"


class LineRuns:
    """The runs of one store, by level, in a folder shared by all executors."""

    def __init__(self, spark: SparkSession, enough: int, fanout: int = 2):
        self.spark, self.enough, self.fanout = spark, enough, fanout
        self.folder = new_folder(spark, "line-runs")
        self.levels: list[list[str]] = []
        self._made = 0

    def totals(self) -> DataFrame:
        """Documents by key over all runs."""
        runs = [self._read(path) for level in self.levels for path in level]
        merged = reduce(DataFrame.union, runs, self.spark.createDataFrame([], RUN))
        return merged.groupBy("key").agg(F.sum("n").alias("n"))

    def common(self) -> DataFrame:
        """Keys found in at least ``enough`` documents."""
        return self.totals().filter(F.col("n") >= self.enough).select("key")

    def add(self, counts: DataFrame) -> None:
        """Adds a batch's ``(key, n)``, but for lines that the runs already show to be common."""
        if self.levels:
            counts = counts.join(self.common(), "key", "left_anti")
        self._append(0, counts)

    def _append(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        path = f"{self.folder}/level={level}/run={self._made}"
        self._made += 1
        run.select("key", "n").sortWithinPartitions("key").write.parquet(path)
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = reduce(DataFrame.union, map(self._read, old)).groupBy("key").agg(F.sum("n").alias("n"))
            self._append(level + 1, merged)
            for path in old:
                drop_folder(self.spark, path)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(path)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """A hash for every line of a text; null for an empty one."""
    lines = lines_of(lower_ascii(text))
    return F.transform(lines, lambda line: _hash(F.btrim(line, F.lit(BLANKS))))


def _hash(line: Column) -> Column:
    return F.when(line != "", F.xxhash64(line))


def drop_common_lines(docs: DataFrame, text: str, batch: Column, batches: int, enough: int = 10) -> DataFrame:
    """``row`` (the whole input row), ``n_lines``, ``n_dropped`` and the ``kept`` text of every document.

    ``batch`` deals documents to ``batches`` numbered batches, which enter the runs one
    after another; the result does not depend on it. A line is dropped in every
    document once ``enough`` documents have it.
    """
    spark = docs.sparkSession
    text = F.col(text)
    # Equal texts have equal lines, so a text stands for its document.
    hashed = docs.select(_text_id(text).alias("id"), batch.alias("batch"), line_keys(text).alias("keys"))
    keyed = written(hashed, "line-keys")
    found = keyed.select("batch", F.explode(F.array_distinct("keys")).alias("key")).filter("key is not null")
    counts = written(found.groupBy("batch", "key").agg(F.count("*").alias("n")), "line-counts")
    runs = LineRuns(spark, enough)
    for number in range(batches):
        runs.add(counts.filter(F.col("batch") == number).select("key", "n"))
    # Written, so that the join below deals both sides itself and can split a hot line.
    common = written(runs.common(), "common-lines")
    lines = keyed.select("id", F.posexplode("keys").alias("pos", "key")).filter("key is not null")
    dropped = lines.join(common, "key", "left_semi").groupBy("id").agg(F.collect_set("pos").alias("dropped"))
    # Written as well: the join with the documents can then split a text that many of them share.
    dropped = written(dropped, "dropped-lines")
    rows = docs.select(F.struct("*").alias("row"), _text_id(text).alias("id"), text.alias("text"))
    joined = rows.join(dropped, "id", "left").withColumn("lines", lines_of(F.col("text")))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("dropped", F.array().cast("array<int>")))
    kept = F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(stays, lambda i: F.get("lines", i)), "\n")
    )
    return joined.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )


def _text_id(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))
