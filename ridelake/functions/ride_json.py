"""The JSON body of a ride event."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.schemas import PAYLOAD, RIDES

# Fixed value: ISO time with microseconds and offset. Spark's default writes
# milliseconds only; reading needs no pattern, it takes any ISO form.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def ride_to_json(more: Sequence[str] = ()) -> Column:
    """Every ride column but the key, and ``more`` columns, as one JSON string.

    NULL fields are left out, and so are values that are not of their type, such as a
    time that is none, with ANSI mode on and off.
    """
    body = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RIDES.fields if f.name != "key"]
    return F.to_json(F.struct(*body, *more), {"timestampFormat": TIMESTAMP_FORMAT})


def json_to_ride(value: Column, corrupt_column: str | None = None) -> Column:
    """The parsed body. A broken document gives NULL fields, a broken field a NULL field.

    With ``corrupt_column`` the text of a broken record is kept under that name.
    """
    if corrupt_column is None:
        return F.from_json(value, PAYLOAD)
    schema = T.StructType([*PAYLOAD.fields, T.StructField(corrupt_column, T.StringType(), True)])
    return F.from_json(value, schema, {"columnNameOfCorruptRecord": corrupt_column})


def body_fields(body: Column) -> Column:
    """A VARIANT object as a map of its fields; NULL for anything else."""
    return body.try_cast("map<string, variant>")


def unknown_rest(value: Column) -> Column:
    """The fields of a body that the ride schema does not have, as a VARIANT object; NULL if there are none.

    A text that is no object, or that names a field twice, cannot be taken apart: it is kept whole, as a VARIANT string.
    """
    known = [f.name for f in PAYLOAD.fields]
    body = F.try_parse_json(value)
    fields = F.map_filter(body_fields(body), lambda name, _: ~name.isin(known))
    taken_apart = F.when(F.size(fields) > 0, F.to_variant_object(fields))
    return F.when(body_fields(body).isNotNull(), taken_apart).otherwise(value.cast("variant"))
