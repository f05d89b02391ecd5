"""Ride and neighbourhood sources, and the check that a source is ready."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridelake.schemas import NEIGHBORHOODS, RIDES


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_rides_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rides from CSV with a header; a cell that does not fit its type becomes NULL."""
    return _read_csv(spark, path, RIDES)


def read_neighborhoods_csv(spark: SparkSession, path: str) -> DataFrame:
    """Neighbourhood names and points from CSV with a header."""
    return _read_csv(spark, path, NEIGHBORHOODS)


def require_rides_csv(spark: SparkSession, path: str | None) -> DataFrame:
    """The rides under ``path``; raises if the path is unset, missing, or holds no row."""
    if not path:
        raise ValueError("the path of the ride source is not set")
    try:
        rides = read_rides_csv(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(path) from missing
    if rides.isEmpty():
        raise ValueError(f"the ride source {path} holds no rows")
    return rides
