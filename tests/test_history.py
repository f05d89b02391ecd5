"""Landing against all that was landed before, and batches that are run again."""

from collections import Counter

import pytest
from helpers import bag, plan, rides
from pyspark.sql import functions as F

from ridelake.operators.events import parse_events, to_events
from ridelake.plans.ingest import land_batch, read_landed
from ridelake.sources.event_log import read_event_stream, write_events
from ridelake.sources.history import KeyHistory, first_of_each
from ridelake.sources.lake import in_date_range
from ridelake.streaming.sinks import finish, start_append


def raw(spark, *rows):
    return parse_events(to_events(rides(spark, *[(k, fare, t, -74.0, 40.0) for k, fare, t in rows])))


def landed(spark, folder):
    return Counter((r["key"], r["fare_amount"]) for r in read_landed(spark, f"{folder}/raw").collect())


JAN, FEB = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def test_a_ride_is_landed_once_over_all_batches(spark, folder):
    history = KeyHistory(spark, f"{folder}/history", 4)
    batches = [
        [("a", 1.0, JAN), ("b", 1.0, JAN), (None, 1.0, JAN), ("n", 1.0, None)],
        [("a", 2.0, FEB), ("c", 2.0, FEB), (None, 1.0, JAN), ("n", 1.0, None)],
        [("c", 3.0, JAN), ("d", 3.0, FEB), ("b", 3.0, JAN)],
    ]
    for number, rows in enumerate(batches):
        land_batch(raw(spark, *rows), f"{folder}/raw", history, f"b{number}")
    assert landed(spark, folder) == {("a", 1.0): 1, ("b", 1.0): 1, ("c", 2.0): 1, ("d", 3.0): 1, (None, 1.0): 2, ("n", 1.0): 1}
    pruned = plan(in_date_range(read_landed(spark, f"{folder}/raw"), "2024-02-01", "2024-02-02"))
    assert "PartitionFilters: [isnotnull(year" in pruned


def test_a_batch_run_again_replaces_itself(spark, folder):
    history = KeyHistory(spark, f"{folder}/history", 4)
    land_batch(raw(spark, ("a", 1.0, JAN)), f"{folder}/raw", history, "one")
    for rows in ([("a", 2.0, JAN), ("b", 2.0, JAN), ("x", 2.0, FEB)], [("b", 3.0, JAN), ("c", 3.0, JAN)]):
        land_batch(raw(spark, *rows), f"{folder}/raw", history, "two")
    assert landed(spark, folder) == {("a", 1.0): 1, ("b", 3.0): 1, ("c", 3.0): 1}
    # The key that the second run no longer brings is not taken for landed.
    land_batch(raw(spark, ("x", 4.0, FEB), ("b", 4.0, FEB)), f"{folder}/raw", history, "three")
    assert landed(spark, folder) == {("a", 1.0): 1, ("b", 3.0): 1, ("c", 3.0): 1, ("x", 4.0): 1}


def test_a_batch_that_failed_between_its_tables_is_run_again(spark, folder, monkeypatch):
    history = KeyHistory(spark, f"{folder}/history", 4)

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(history, "put", fails)
        with pytest.raises(RuntimeError):
            land_batch(raw(spark, ("a", 1.0, JAN)), f"{folder}/raw", history, "one")
    land_batch(raw(spark, ("a", 1.0, JAN)), f"{folder}/raw", history, "one")
    land_batch(raw(spark, ("a", 1.0, JAN)), f"{folder}/raw", history, "two")
    assert landed(spark, folder) == {("a", 1.0): 1}


def test_an_empty_batch_and_bad_names(spark, folder):
    history = KeyHistory(spark, f"{folder}/history", 4)
    land_batch(raw(spark, ("a", 1.0, JAN)).limit(0), f"{folder}/raw", history, "none")
    land_batch(raw(spark, ("a", 1.0, JAN)), f"{folder}/raw", history, "one")
    assert landed(spark, folder) == {("a", 1.0): 1}
    for name in ("", "a/b", "x'y", "a=b"):
        with pytest.raises(ValueError, match="named by letters"):
            history.put(raw(spark, ("a", 1.0, JAN)), name)


def test_a_history_is_found_by_its_folder(spark, folder):
    history = KeyHistory(spark, f"{folder}/it's", 4)
    history.put(raw(spark, ("a", 1.0, JAN), ("b", 1.0, JAN), (None, 1.0, JAN)), "one")
    history.put(raw(spark, ("a", 1.0, JAN)), "two")
    spark.sql(f"DROP TABLE {history.name}")
    found = KeyHistory(spark, f"{folder}/it's", 99)
    assert found.buckets == 4 and bag(found.keys()) == {("one", "a"): 1, ("one", "b"): 1, ("two", "a"): 1}
    small = found.compacted(f"{folder}/small", 2)
    assert small.buckets == 2 and bag(small.keys(), "key") == {("a",): 1, ("b",): 1}
    assert not small.unseen(raw(spark, ("a", 2.0, FEB))).count()
    small.drop()
    assert not KeyHistory(spark, f"{folder}/small", 3).keys().count()


def test_the_history_is_never_shuffled(spark, folder):
    history = KeyHistory(spark, f"{folder}/history", 5)
    history.put(spark.range(500).select(F.col("id").cast("string").alias("key")), "one")
    history.put(spark.range(500, 900).select(F.col("id").cast("string").alias("key")), "two")
    new = spark.range(800, 1000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("v"))
    fresh = history.unseen(new)
    assert {int(r["key"]) for r in fresh.collect()} == set(range(900, 1000))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    lines = history.unseen(new)._jdf.queryExecution().executedPlan().toString().splitlines()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    scan = next(i for i, line in enumerate(lines) if "ridelake_keys" in line)
    assert "Bucketed: true" in lines[scan] and "SelectedBucketsCount: 5 out of 5" in lines[scan]
    # From the scan up to the join: every line that is less indented than the ones below it.
    above, depth = [], len(lines[scan])
    for line in reversed(lines[:scan]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            above.append(line)
            depth = indent
        if "SortMergeJoin" in line:
            break
    assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)
    assert sum("Exchange" in line for line in lines) == 1


def test_a_stream_sees_the_history(spark, folder):
    history = KeyHistory(spark, f"{folder}/history", 4)
    history.put(raw(spark, ("a", 1.0, JAN)), "one")
    write_events(to_events(rides(spark, ("a", 2.0, FEB, -74.0, 40.0), ("b", 2.0, FEB, -74.0, 40.0), (None, 2.0, FEB, -74.0, 40.0))), f"{folder}/log")
    rows = history.unseen(parse_events(read_event_stream(spark, f"{folder}/log")))
    finish(start_append(rows, f"{folder}/out", f"{folder}/c", available_now=True))
    assert bag(spark.read.parquet(f"{folder}/out"), "key") == {("b",): 1, (None,): 1}


def test_first_of_each(spark):
    rows = [("a", 2.0, JAN), ("a", 1.0, JAN), ("a", 0.0, FEB), ("n", 1.0, None), ("n", 1.0, None), (None, 1.0, JAN), (None, 1.0, JAN)]
    found = first_of_each(raw(spark, *rows, *[("hot", 5.0, JAN)] * 300, *[(None, 7.0, None)] * 300).repartition(4))
    assert Counter((r["key"], r["fare_amount"]) for r in found.collect()) == {("a", 1.0): 1, ("n", 1.0): 2, (None, 1.0): 2, ("hot", 5.0): 1, (None, 7.0): 300}
    with_rest = parse_events(to_events(rides(spark, ("a", 1.0, JAN, -74.0, 40.0)).withColumn("tip", F.lit(1)), more=("tip",)), rest="rest")
    assert first_of_each(with_rest.unionAll(with_rest)).count() == 1
