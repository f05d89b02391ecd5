"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.sources.workspace import drop_folder, new_folder, written


def components(edges: DataFrame) -> DataFrame:
    """``v`` and the smallest vertex ``root`` it is connected with, for every vertex of the edges ``(a, b)``.

    Each step is a join and a grouping over edges; vertices with many edges are reduced
    to their minimum in the map tasks. The minima are written before they are joined, so that
    the join deals both sides itself and adaptive execution can split a vertex with many edges. The
    number of steps grows with the logarithm of the number of vertices. Edges are written after every step, so a lost executor costs one
    step at most. Edges with a null end or from a vertex to itself are left out; without edges
    there are no rows.
    """
    spark = edges.sparkSession
    ends = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    folder, mark = new_folder(spark, "components"), None
    ends.distinct().write.parquet(f"{folder}/step=0")
    step = 0
    while True:
        current = spark.read.schema(ends.schema).parquet(f"{folder}/step={step}")
        seen = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if seen == mark or not seen[0]:
            roots = current.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct()
            return current.select(F.col("a").alias("v"), F.col("b").alias("root")).union(roots)
        mark = seen
        _small_star(written(_large_star(current), "large-star")).distinct().write.parquet(f"{folder}/step={step + 1}")
        drop_folder(spark, f"{folder}/step={step}")
        step += 1


def _large_star(edges: DataFrame) -> DataFrame:
    """Connects every larger neighbour of a vertex with the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("w"))
    both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("w")))
    least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = written(least, "least")
    return both.filter("w > u").join(least, "u").select(F.col("w").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connects a vertex and its smaller neighbours with the smallest of them."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))
