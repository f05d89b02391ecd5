from helpers import bag, plan, rides
from pyspark.sql import functions as F

from ridelake.operators.rows import distinct_rows, random_parts, with_coordinates, with_part

PAIRS = [("k7", "oak"), ("k2", "elm"), ("k9", ""), ("k4", None), ("k1", "fir"), ("k8", "oak")]


def test_only_rides_with_both_coordinates_stay(spark):
    df = rides(
        spark,
        ("a", 1.0, "2024-01-01 00:00:00", -73.9, 40.7),
        ("b", 1.0, "2024-01-01 00:00:00", None, 40.7),
        ("c", 1.0, "2024-01-01 00:00:00", -73.9, None),
    )
    assert bag(with_coordinates(df), "key") == {("a",): 1}


def test_coordinate_filter_reaches_the_scan(spark, folder):
    rides(spark, ("a", 1.0, "2024-01-01 00:00:00", -73.9, 40.7)).write.parquet(f"{folder}/t")
    text = plan(with_coordinates(spark.read.parquet(f"{folder}/t")).select("key"))
    assert "PushedFilters: [IsNotNull(pickup_latitude), IsNotNull(pickup_longitude)]" in text


def test_random_parts_hold_every_row_once(spark):
    df = spark.createDataFrame(PAIRS, "key string, value string")
    parts = random_parts(df, 10)
    assert len(parts) == 10
    assert sum(p.count() for p in parts) == df.count()
    large = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    kept = [p for p in random_parts(large, 10, seed=3) if not p.isEmpty()]
    rows = bag(kept[0])
    for part in kept[1:]:
        rows += bag(part)
    assert rows == bag(large)
    assert all(100 < p.count() < 300 for p in kept)


def test_fixed_parts_are_whole_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    once, again = with_part(df, 7), with_part(df.repartition(5), 7)
    assert bag(once) == bag(again)
    assert {r["part"] for r in once.collect()} == set(range(7))
    by_number = with_part(df, 10, F.col("key").cast("bigint"))
    assert by_number.groupBy("part").count().filter("count <> 100").isEmpty()


def test_distinct_rows_collapses_copies_before_the_shuffle(spark):
    df = spark.createDataFrame(PAIRS + PAIRS[:2] + [(None, None), (None, None)], "key string, value string")
    assert bag(distinct_rows(df)) == {**{p: 1 for p in PAIRS}, (None, None): 1}
    tree = [line for line in plan(distinct_rows(df)).split("\n\n")[0].splitlines() if "HashAggregate" in line or "Exchange" in line]
    assert ["HashAggregate" in line for line in tree] == [True, False, True]
