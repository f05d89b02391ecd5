"""Casts, date parts and money."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def narrowed(schema: T.StructType, names: list[str] | None = None) -> list[Column]:
    """The schema's columns, each cast to its type; values that do not fit become NULL.

    ``try_cast`` gives the same answer with ANSI mode on and off, so a longitude
    of -173.5 or 208 passengers never fails a job.
    """
    fields = schema.fields if names is None else [schema[name] for name in names]
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]


def date_parts(time: str) -> dict[str, Column]:
    """Year, month and day of ``time`` in the session time zone, in partition types."""
    return {
        "year": F.year(time).cast(T.ShortType()),
        "month": F.month(time).cast(T.ByteType()),
        "day": F.dayofmonth(time).cast(T.ByteType()),
    }


def spread(df: DataFrame, n: int) -> Column:
    """A number in ``[0, n)`` that breaks up rows which would otherwise share a shuffle key.

    It depends on the row and on its task's place in the input, so copies of one
    row differ too, and a task that is run again after a lost executor gives every
    row the same number. A random number would not, and rows could get lost.
    """
    hashed = [F.col(name).cast("string") if dtype == "variant" else F.col(name) for name, dtype in df.dtypes]
    return F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(n)).cast("int")


def cents(fare: str) -> Column:
    """The fare in whole cents, so that sums are exact in any order."""
    return F.round(F.col(fare).cast("double") * 100).try_cast("bigint")
