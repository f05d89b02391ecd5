"""Rows counted as they pass."""

import pytest
from helpers import rides
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ridelake.operators.events import flag_bad_records, to_events
from ridelake.sources.event_log import read_event_stream, write_events
from ridelake.sources.lake import append_partitioned
from ridelake.streaming.counts import counted, totals
from ridelake.streaming.landing import land
from ridelake.streaming.sinks import finish


@pytest.fixture
def events(spark):
    good = to_events(rides(spark, *[(str(i), 1.0, "2024-01-01 00:00:00", -74.0, 40.0) for i in range(7)], ("late", 1.0, None, -74.0, 40.0)))
    return good.unionAll(spark.createDataFrame([("x", "{bad"), ("y", "{bad")], "key string, value string"))


def test_a_batch_reads_once_and_knows_its_counts(spark, events, folder):
    events.repartition(3).write.parquet(f"{folder}/log")
    read, wrote = Observation(), Observation()
    flagged = counted(flag_bad_records(spark.read.parquet(f"{folder}/log")), read, "read", bad=F.col("bad_text").isNotNull())
    good = counted(flagged.filter("bad_text is null").drop("bad_text"), wrote, "written")
    assert good._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    append_partitioned(good, f"{folder}/raw")
    assert read.get | wrote.get == {"read": 10, "bad": 2, "written": 8}


def test_a_stream_counts_every_run_of_its_own(spark, events, folder):
    def run(**options):
        stream = read_event_stream(spark, f"{folder}/log", max_files=1)
        query = land(stream, f"{folder}/raw", f"{folder}/c", available_now=True, counts="here", **options)
        finish(query)
        return totals(query, "here") | totals(query, "here_written")

    write_events(events.repartition(4), f"{folder}/log")
    assert run() == {"read": 10, "bad": 2, "undated": 3, "written": 10}
    assert run() == {}
    write_events(events.limit(5), f"{folder}/log")
    assert run(files_per_day=2) == {"read": 5, "bad": 0, "undated": 0, "written": 5}
    assert spark.read.parquet(f"{folder}/raw").count() == 15 and "_corrupt" not in spark.read.parquet(f"{folder}/raw").columns


def test_lost_reports_are_not_taken_for_all(spark, events, folder):
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        write_events(events.repartition(4), f"{folder}/log")
        query = land(read_event_stream(spark, f"{folder}/log", max_files=1), f"{folder}/raw", f"{folder}/c", available_now=True, counts="here")
        finish(query)
        with pytest.raises(ValueError, match="more micro-batches"):
            totals(query, "here")
    finally:
        spark.conf.set(name, before)
