import json

import pytest
from helpers import bag, plan, rides
from pyspark.sql import functions as F

from ridelake.operators.events import flag_bad_records, parse_events, split_bad_records, to_events
from ridelake.operators.rows import with_coordinates
from ridelake.schemas import EVENTS, PAYLOAD, RAW

ONE = ("1", 8.25, "2031-07-04 05:06:07.000891", 12.251, 51.503, 12.3, 51.42, 4)
TWO = ("2", 41.75, "2031-07-05 23:59:59", 12.28, 51.39, 12.31, 51.55, 3)


def events(spark, *values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], EVENTS)


def test_events_have_key_and_json_body(spark):
    out = to_events(rides(spark, ONE))
    assert out.schema == EVENTS
    row = out.first()
    assert row["key"] == "1"
    body = json.loads(row["value"])
    assert list(body) == PAYLOAD.names
    assert body["fare_amount"] == 8.25 and body["passenger_count"] == 4
    assert body["pickup_datetime"] == "2031-07-04T05:06:07.000891Z"


def test_null_fields_are_left_out_and_come_back_null(spark):
    ride = ("1", None, None, None, 40.7, None, 40.7, None)
    out = to_events(rides(spark, ride))
    assert set(json.loads(out.first()["value"])) == {"pickup_latitude", "dropoff_latitude"}
    back = parse_events(out).first()
    assert back["fare_amount"] is None and back["pickup_datetime"] is None and back["year"] is None
    assert back["pickup_latitude"] == 40.7


def test_round_trip_is_typed_and_keeps_microseconds(spark):
    source = rides(spark, ONE, TWO)
    raw = parse_events(to_events(source))
    assert raw.schema == RAW
    kept = ["key", "pickup_datetime", "pickup_longitude", "dropoff_latitude"]
    assert bag(raw, *kept) == bag(source, *kept)
    first = raw.filter("key = '1'").first()
    assert (first["year"], first["month"], first["day"], first["passenger_count"]) == (2031, 7, 4, 4)


def test_key_and_value_may_be_bytes(spark):
    out = to_events(rides(spark, ONE))
    binary = out.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    assert bag(parse_events(binary)) == bag(parse_events(out))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-02-21T10:30:00", "2024-02-21 10:30:00"),
        ("2009-06-15T14:26:21.000-03:00", "2009-06-15 17:26:21"),
        ("2009-06-15 17:26:21 UTC", "2009-06-15 17:26:21"),
        ("2009-06-15T14:26:21.000001Z", "2009-06-15 14:26:21.000001"),
    ],
)
def test_any_iso_time_is_read(spark, text, expected):
    raw = parse_events(events(spark, json.dumps({"pickup_datetime": text})))
    assert raw.select(F.col("pickup_datetime").cast("string")).first()[0] == expected


def test_unreadable_records_keep_their_row_and_key(spark):
    raw = parse_events(events(spark, "{bad", None, '{"fare_amount": "x", "passenger_count": 3}'))
    rows = {r["key"]: r for r in raw.collect()}
    assert len(rows) == 3
    assert all(rows["0"][c] is None for c in RAW.names if c != "key")
    assert all(rows["1"][c] is None for c in RAW.names if c != "key")
    assert rows["2"]["fare_amount"] is None and rows["2"]["passenger_count"] == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_passengers_that_do_not_fit_become_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        raw = parse_events(events(spark, '{"passenger_count": 208}', '{"passenger_count": 127}'))
        assert sorted(raw.collect(), key=lambda r: r["key"])[0]["passenger_count"] is None
        assert sorted(raw.collect(), key=lambda r: r["key"])[1]["passenger_count"] == 127
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_date_parts_follow_the_session_zone(spark, zone):
    source = events(spark, '{"pickup_datetime": "2009-01-01T00:40:21Z"}')
    assert parse_events(source).select("year", "month", "day").first() == (2009, 1, 1)
    zone("-03:00")
    assert parse_events(source).select("year", "month", "day").first() == (2008, 12, 31)


def test_bad_records_are_split_off_with_their_text(spark):
    good, bad = split_bad_records(events(spark, '{"fare_amount": 1.5}', "{bad", '{"passenger_count": "x"}', None))
    assert good.schema == RAW
    assert bag(good, "key", "fare_amount") == {("0", 1.5): 1, ("3", None): 1}
    assert bag(bad) == {("1", "{bad"): 1, ("2", '{"passenger_count": "x"}'): 1}


def test_a_filter_after_parsing_does_not_parse_again(spark):
    text = plan(with_coordinates(parse_events(events(spark, "{}"))))
    assert text.count("from_json") == 1
    assert "Exchange" not in text


def test_flagged_records_are_read_and_parsed_once(spark, folder):
    events(spark, '{"fare_amount": 1.5}', "{bad", None).write.parquet(f"{folder}/log")
    flagged = flag_bad_records(spark.read.parquet(f"{folder}/log"))
    assert bag(flagged, "key", "fare_amount", "bad_text") == {("0", 1.5, None): 1, ("1", None, "{bad"): 1, ("2", None, None): 1}
    both = flagged.select("key", F.col("bad_text").isNotNull().alias("is_bad"))
    assert plan(flagged).count("from_json") == 1 and plan(both).count("Scan parquet") == 2  # in the tree and its details


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_text_that_is_no_time_becomes_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        wild = spark.createDataFrame(
            [("1", "7.5", "soon", "x", "51.5", None, None, "many"), ("2", "oops", "2031-07-04 05:06:07", "12.2", "51.5", "1", "2", "3")],
            "key string, fare_amount string, pickup_datetime string, pickup_longitude string, pickup_latitude string,"
            " dropoff_longitude string, dropoff_latitude string, passenger_count string",
        )
        one, two = (parse_events(to_events(wild.filter(f"key = '{k}'"))).first() for k in "12")
        assert (one["fare_amount"], one["pickup_datetime"], one["pickup_longitude"], one["passenger_count"]) == (7.5, None, None, None)
        assert two["fare_amount"] is None and two["year"] == 2031 and two["passenger_count"] == 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
