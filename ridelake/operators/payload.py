"""Fields that events bring beyond the ride schema: kept, reported, and made columns.

``parse_events(..., rest=...)`` keeps them in one VARIANT column, so a table can hold them before anybody knows
their names. ``field_report`` tells which there are, ``new_fields`` which column types they take, and ``promoted`` makes
them columns, in batch or in a stream, of new rows or of a table read back.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.ride_json import body_fields
from ridelake.schemas import RAW

REST = "rest"
# The column type for what all values of a field have in common. Whatever else they have in common, or
# nothing, is kept as text: that of a string itself, and JSON for objects and lists.
COLUMN_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "double", "DECIMAL": "double", "BOOLEAN": "boolean"}
TEXT = "string"


def raw_with(rest: str = REST, fields: Mapping[str, str] | None = None) -> T.StructType:
    """The raw schema with the rest, and with promoted columns."""
    grown = T.StructType([*RAW.fields, T.StructField(rest, T.VariantType())])
    for name, dtype in (fields or {}).items():
        grown = grown.add(name, T.DataType.fromDDL(dtype))
    return grown


def field_report(raw: DataFrame, rest: str = REST) -> DataFrame:
    """``field``, ``rows`` that have it, the ``variant_type`` that all its values share, and the ``column_type`` it takes.

    One aggregation, combined in the map tasks: a row for every field name. Values that clash share the type VARIANT.
    """
    named = raw.select(F.explode(body_fields(F.col(rest))).alias("field", "value"))
    found = named.groupBy("field").agg(
        F.count("*").alias("rows"), F.schema_of_variant_agg(F.col("value")).alias("variant_type")
    )
    kind = F.regexp_extract("variant_type", r"^\w+", 0)
    types = F.create_map(*[F.lit(x) for pair in COLUMN_TYPES.items() for x in pair])
    return found.withColumn("column_type", F.coalesce(F.try_element_at(types, kind), F.lit(TEXT)))


def new_fields(raw: DataFrame, rest: str = REST, most: int = 1000) -> dict[str, str]:
    """Field names and column types, by name; raises if there are more than ``most`` (names that are data, not fields)."""
    rows = field_report(raw, rest).select("field", "column_type").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} new fields: choose some from the report")
    return dict(sorted((row["field"], row["column_type"]) for row in rows))


def _value(value: Column, dtype: str) -> Column:
    return F.try_variant_get(value, "$", dtype)


def promoted(
    raw: DataFrame, fields: Mapping[str, str], rest: str = REST, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Raw rides with the ``fields`` (name and type) of their rest as columns; ``names`` gives some another name.

    A value that is not of its column's type leaves the column NULL and stays in the rest, so none is lost; all others leave the rest,
    which is NULL once it is empty. Where the table has such a column already, rows that have a value
    keep it: rows landed before a field was known and after it then read alike.
    """
    columns = {field: (names or {}).get(field, field) for field in fields}
    taken = [name.lower() for name in [*RAW.names, rest, *columns.values()]]
    if clashing := {name for name in columns.values() if taken.count(name.lower()) > 1}:
        raise ValueError(f"columns of these names are there already, give others: {sorted(clashing)}")
    held = {name.lower() for name in raw.columns}
    found = {}
    for field, column in columns.items():
        value = _value(F.try_element_at(body_fields(F.col(rest)), F.lit(field)), fields[field])
        found[column] = F.coalesce(F.col(column), value) if column.lower() in held else value

    def stays(name: Column, value: Column) -> Column:
        fits = F.lit(False)
        for field, dtype in fields.items():
            fits = fits | ((name == field) & (_value(value, dtype).isNotNull() | F.is_variant_null(value)))
        return ~fits

    left = F.map_filter(body_fields(F.col(rest)), stays)
    smaller = F.when(F.size(left) > 0, F.to_variant_object(left))
    whole = F.col(rest).isNotNull() & body_fields(F.col(rest)).isNull()
    return raw.withColumns({**found, rest: F.when(whole, F.col(rest)).otherwise(smaller)})
