import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from helpers import bag, largest_task, plan
from pyspark.sql import functions as F

from ridelake.functions.columns import spread
from ridelake.operators.joins import interval_left_join, left_join_salted, left_join_small, reattach

TEN = timedelta(minutes=10)
BASE = datetime(2024, 1, 1)


def left_rows(spark, rows):
    return spark.createDataFrame(rows, "key string, id int, at string").select(
        "key", "id", F.col("at").cast("timestamp").alias("pickup_datetime")
    )


def right_rows(spark, rows):
    return spark.createDataFrame(rows, "near_key string, label string, at string").select(
        "near_key", "label", F.col("at").cast("timestamp").alias("near_time")
    )


def text(moment):
    return None if moment is None else moment.isoformat(sep=" ")


def brute_pairs(left, right):
    out = Counter()
    for key, number, at in left:
        hits = [
            label
            for other, label, then in right
            if key is not None and key == other and at is not None and then is not None and abs(at - then) <= TEN
        ]
        out.update((number, label) for label in hits or [None])
    return out


def test_both_ends_of_the_interval_count(spark):
    tick = timedelta(microseconds=1)
    times = {"low": BASE - TEN, "high": BASE + TEN, "under": BASE - TEN - tick, "over": BASE + TEN + tick}
    joined = interval_left_join(
        left_rows(spark, [("k", 1, text(BASE))]),
        right_rows(spark, [("k", name, text(at)) for name, at in times.items()]),
    )
    assert joined.columns == ["key", "id", "pickup_datetime", "label"]
    assert bag(joined, "label") == {("low",): 1, ("high",): 1}


def test_unmatched_and_null_rows_stay(spark):
    left = [("k", 1, text(BASE)), ("other", 2, text(BASE)), (None, 3, text(BASE)), ("k", 4, None)]
    right = [("k", "a", text(BASE)), (None, "b", text(BASE)), ("k", "c", None)]
    joined = interval_left_join(left_rows(spark, left), right_rows(spark, right))
    assert bag(joined, "id", "label") == {(1, "a"): 1, (2, None): 1, (3, None): 1, (4, None): 1}


def random_rows(seed, count, base):
    """Few keys, one of them with a third of all rows; times in quarter minutes, with some nulls."""
    draw = random.Random(seed)
    rows = []
    for number in range(count):
        key = "hot" if draw.random() < 0.34 else draw.choice(["a", "b", "c", None])
        at = None if draw.random() < 0.05 else base + timedelta(seconds=15 * draw.randrange(600))
        rows.append((key, number, at))
    return rows


@pytest.mark.parametrize("base", [BASE, datetime(1969, 12, 31, 23), datetime(1950, 6, 1)])
def test_interval_join_equals_comparing_all_pairs(spark, base):
    left = random_rows(1, 150, base)
    right = [(key, f"r{number}", at) for key, number, at in random_rows(2, 150, base)]
    joined = interval_left_join(
        left_rows(spark, [(k, n, text(t)) for k, n, t in left]),
        right_rows(spark, [(k, n, text(t)) for k, n, t in right]),
    )
    assert bag(joined, "id", "label") == brute_pairs(left, right)


@pytest.mark.parametrize("base", [BASE, datetime(1969, 12, 31, 23), datetime(1950, 6, 1)])
def test_reattach_equals_the_distinct_pairs(spark, base):
    left = random_rows(3, 200, base)
    right = [(key, f"c{number % 4}", at) for key, number, at in random_rows(4, 200, base)]
    rides = left_rows(spark, [(k, n, text(t)) for k, n, t in left])
    assigned = right_rows(spark, [(k, n, text(t)) for k, n, t in right]).withColumnsRenamed(
        {"near_key": "key", "near_time": "pickup_datetime"}
    )
    out = reattach(rides, assigned, "label")
    assert out.columns == ["key", "id", "pickup_datetime", "label"]
    assert bag(out, "id", "label") == Counter(set(brute_pairs(left, right)))


def test_reattach_counts_both_ends(spark):
    tick = timedelta(microseconds=1)
    marks = {"low": BASE - TEN, "high": BASE + TEN, "under": BASE - TEN - tick, "over": BASE + TEN + tick}
    for shift in (timedelta(0), timedelta(minutes=3, microseconds=7), TEN - tick, TEN, 2 * TEN - tick):
        rides = left_rows(spark, [("k", 1, text(BASE + shift))])
        assigned = right_rows(spark, [("k", n, text(t + shift)) for n, t in marks.items()]).withColumnsRenamed(
            {"near_key": "key", "near_time": "pickup_datetime"}
        )
        assert bag(reattach(rides, assigned, "label"), "label") == {("low",): 1, ("high",): 1}


def test_a_hot_key_is_spread_over_time_slots(spark):
    """Rows of one key a day long share no join group beyond a few slots, and copies are merged before the join."""
    hot = spark.range(2880).select(
        F.lit("k").alias("key"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 30).alias("pickup_datetime")
    )
    assigned = hot.withColumn("label", F.lit("c"))
    assert reattach(hot, assigned, "label").count() == 2880
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        # 72 slots over 16 tasks; all of the key's rows in one task would be 2,880.
        assert largest_task(reattach(hot, assigned, "label")) < 2880 / 4
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    pairs = interval_left_join(
        hot, hot.select(F.col("key").alias("near_key"), F.col("pickup_datetime").alias("near_time"))
    )
    # 41 partners within +/-10 minutes at 30 s steps, fewer at both ends.
    assert pairs.count() == 2880 * 41 - 2 * sum(range(1, 21))


def test_salted_join_equals_the_broadcast_join(spark):
    rows = [(i, 0 if i % 3 else 1) for i in range(300)] + [(300, None), (301, 9)]
    rides = spark.createDataFrame(rows, "id int, cluster int").repartition(4)
    dim = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (None, "d")], "cluster int, region string")
    small, salted = left_join_small(rides, dim, "cluster"), left_join_salted(rides, dim, "cluster", 8)
    assert bag(small) == bag(salted)
    assert bag(small.filter("region IS NULL"), "id") == {(300,): 1, (301,): 1}
    assert "BroadcastHashJoin" in plan(small)


def test_copies_are_spread_by_the_salt(spark):
    copies = spark.range(4000, numPartitions=16).select(F.lit(0).alias("cluster"))
    numbers = copies.withColumn("n", spread(copies, 64))
    assert numbers.select("n").distinct().count() == 16
    assert bag(numbers) == bag(copies.withColumn("n", spread(copies, 64)))


def test_labels_combine_before_they_are_shuffled(spark):
    rides = left_rows(spark, [("k", 1, text(BASE))])
    out = reattach(rides, rides.withColumn("label", F.lit("c")).drop("id"), "label")
    assert "partial_max(_until" in plan(out) and "partial_min(_since" in plan(out)
