"""One definition of every table shape in the lake.

The types are fixed values of the data model: readers always pass them, so
nothing is inferred and partition columns keep their narrow types.
"""

from pyspark.sql import types as T

COORDINATE = T.DecimalType(8, 6)
DATE_PARTS = ["year", "month", "day"]
REGION_PARTS = [*DATE_PARTS, "pickup_region"]
COORDINATES = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Source rides, as the CSV holds them.
RIDES = _struct(
    key=T.StringType(),
    fare_amount=T.DoubleType(),
    pickup_datetime=T.TimestampType(),
    pickup_longitude=T.DoubleType(),
    pickup_latitude=T.DoubleType(),
    dropoff_longitude=T.DoubleType(),
    dropoff_latitude=T.DoubleType(),
    passenger_count=T.IntegerType(),
)

# The JSON body of one event. The passenger count is read as int and narrowed
# afterwards: read straight as a byte, 208 would silently become -48.
PAYLOAD = _struct(
    fare_amount=T.FloatType(),
    pickup_datetime=T.TimestampType(),
    pickup_longitude=T.DoubleType(),
    pickup_latitude=T.DoubleType(),
    dropoff_longitude=T.DoubleType(),
    dropoff_latitude=T.DoubleType(),
    passenger_count=T.IntegerType(),
)

EVENTS = _struct(key=T.StringType(), value=T.StringType())

RAW = _struct(
    key=T.StringType(),
    fare_amount=T.FloatType(),
    pickup_datetime=T.TimestampType(),
    pickup_longitude=T.DoubleType(),
    pickup_latitude=T.DoubleType(),
    dropoff_longitude=T.DoubleType(),
    dropoff_latitude=T.DoubleType(),
    passenger_count=T.ByteType(),
    year=T.ShortType(),
    month=T.ByteType(),
    day=T.ByteType(),
)

NEIGHBORHOODS = _struct(neighborhood=T.StringType(), latitude=COORDINATE, longitude=COORDINATE)

CURATED = _struct(
    key=T.StringType(),
    fare_amount=T.FloatType(),
    pickup_datetime=T.TimestampType(),
    pickup_longitude=COORDINATE,
    pickup_latitude=COORDINATE,
    dropoff_longitude=COORDINATE,
    dropoff_latitude=COORDINATE,
    passenger_count=T.ByteType(),
    year=T.ShortType(),
    month=T.ByteType(),
    day=T.ByteType(),
    pickup_region=T.StringType(),
)
