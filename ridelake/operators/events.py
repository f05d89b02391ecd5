"""Rides to keyed JSON events and back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.columns import date_parts
from ridelake.functions.ride_json import json_to_ride, ride_to_json, unknown_rest
from ridelake.schemas import EVENTS, RAW


def to_events(rides: DataFrame, keep: tuple[str, ...] = (), more: tuple[str, ...] = ()) -> DataFrame:
    """One ``(key, value)`` event per ride; ``keep`` passes further columns through, ``more`` columns go into the body."""
    return rides.select(F.col("key").cast("string").alias("key"), ride_to_json(more).alias("value"), *keep)


def parse_events(events: DataFrame, corrupt_column: str | None = None, rest: str | None = None) -> DataFrame:
    """Events to raw rides: parsed, typed, with the date parts of the pickup time.

    Key and value may be strings or bytes. No row is lost: an unreadable event
    keeps its key and has NULL fields, and so lands in the NULL date partition.

    With ``rest`` no field is lost either: those that the ride schema does not have are kept under that name as a
    VARIANT object (see ``operators.payload``). That parses the text a second time.
    """
    # inline, unlike a struct column, keeps a later filter from parsing the text once more per column it tests.
    text = F.col("value").cast("string")
    parsed = events.select(
        F.col("key").cast("string").alias("key"),
        *([] if rest is None else [unknown_rest(text).alias(rest)]),
        F.inline(F.array(json_to_ride(text, corrupt_column))),
    )
    typed = {"passenger_count": F.col("passenger_count").try_cast("tinyint"), **date_parts("pickup_datetime")}
    extra = [name for name in (corrupt_column, rest) if name is not None]
    return parsed.withColumns(typed).select(*RAW.names, *extra)


def flag_bad_records(events: DataFrame, bad_text: str = "bad_text") -> DataFrame:
    """Raw rides with ``bad_text``, the text of a record that could not be read, else NULL.

    For whoever needs good and bad records: everything is read and parsed once.
    """
    return parse_events(events, bad_text)


def split_bad_records(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good raw rides, bad records with the key and the text that could not be read).

    Two frames, each of which parses the events when it is used.
    """
    flagged = flag_bad_records(events, "_corrupt")
    good = flagged.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    bad = flagged.filter(F.col("_corrupt").isNotNull()).select("key", F.col("_corrupt").alias("value"))
    return good, bad


def event_columns(df: DataFrame) -> DataFrame:
    """Only the columns of an event."""
    return df.select(*EVENTS.names)
