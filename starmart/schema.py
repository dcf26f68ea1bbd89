"""Declared schemas of the inputs and of the star, and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TS = T.TimestampNTZType()
_D = T.DoubleType()
_I = T.IntegerType()
_L = T.LongType()
_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Trips with coordinates (the CSV lane). Column order is the staging order and
# is also the tie-break order of trip ids.
TRIPS_COORD = _struct(
    ("pickup_datetime", _TS),
    ("dropoff_datetime", _TS),
    ("pickup_latitude", _D),
    ("pickup_longitude", _D),
    ("dropoff_latitude", _D),
    ("dropoff_longitude", _D),
    ("passenger_count", _I),
    ("trip_distance", _D),
    ("fare_amount", _D),
    ("tip_amount", _D),
    ("total_amount", _D),
    ("payment_type", _L),
)

# Trips with zone ids (the Parquet lane), after renaming.
TRIPS_ZONE = _struct(
    ("pickup_datetime", _TS),
    ("dropoff_datetime", _TS),
    ("passenger_count", _I),
    ("trip_distance", _D),
    ("pickup_location_id", _L),
    ("dropoff_location_id", _L),
    ("payment_type", _L),
    ("fare_amount", _D),
    ("tip_amount", _D),
    ("total_amount", _D),
)

COORD_COLUMNS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
ZONE_COLUMNS = ["pickup_location_id", "dropoff_location_id"]

# Source column name -> pipeline column name for the Parquet lane.
ZONE_RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

_PARTS = [("hour", _I), ("day", _I), ("month", _I), ("year", _I), ("weekday", _I)]

DIM_DATETIME = _struct(
    ("datetime_id", _L),
    ("pickup_datetime", _TS),
    *[(f"pickup_{p}", t) for p, t in _PARTS],
    ("dropoff_datetime", _TS),
    *[(f"dropoff_{p}", t) for p, t in _PARTS],
)
DIM_DATETIME_ZONE = _struct(
    ("datetime_id", _L), ("pickup_datetime", _TS), *[(f"pickup_{p}", t) for p, t in _PARTS]
)
DIM_LOCATION = _struct(
    ("location_id", _L),
    *[(c, _D) for c in COORD_COLUMNS],
    ("pickup_location_name", _S),
    ("dropoff_location_name", _S),
)
DIM_LOCATION_ZONE = _struct(("location_id", _L), ("pickup_location_id", _L), ("dropoff_location_id", _L))
DIM_PAYMENT = _struct(
    ("payment_id", _L), ("payment_type", _S), ("payment_name", _S), ("payment_description", _S)
)
DIM_PAYMENT_RAW = _struct(("payment_id", _L), ("payment_name", _L))
DIM_PASSENGER = _struct(("passenger_id", _L), ("passenger_count", _I))

FACT = _struct(
    ("trip_id", _L),
    ("datetime_id", _L),
    ("location_id", _L),
    ("payment_id", _L),
    ("passenger_id", _L),
    ("trip_distance", _D),
    ("fare_amount", _D),
    ("tip_amount", _D),
    ("total_amount", _D),
    ("trip_duration", _I),
)
FACT_ZONE = _struct(
    ("trip_id", _L),
    ("datetime_id", _L),
    ("pickup_location_id", _L),
    ("dropoff_location_id", _L),
    ("payment_id", _L),
    ("passenger_id", _L),
    ("trip_distance", _D),
    ("trip_duration", _D),
    ("fare_amount", _D),
    ("tip_amount", _D),
    ("total_amount", _D),
)


#: The declared schema of each written table, by the star's variant.
STAR_SCHEMAS = {
    "coords": {
        "dim_datetime": DIM_DATETIME,
        "dim_location": DIM_LOCATION,
        "dim_payment": DIM_PAYMENT,
        "dim_passenger": DIM_PASSENGER,
        "fact_trips": FACT,
    },
    "zones": {
        "dim_datetime": DIM_DATETIME_ZONE,
        "dim_location": DIM_LOCATION_ZONE,
        "dim_payment": DIM_PAYMENT_RAW,
        "dim_passenger": DIM_PASSENGER,
        "fact_trips": FACT_ZONE,
    },
}


def conform(df: DataFrame, schema: T.StructType, round_to_int: bool = True) -> DataFrame:
    """Select ``schema``'s columns in order and cast each to its declared type.

    A fractional double stored into an integer column is rounded half-even
    first (a database's store rounds; Spark's cast would truncate).
    """
    cols = []
    for field in schema.fields:
        c = F.col(field.name)
        src = df.schema[field.name].dataType
        if (
            round_to_int
            and isinstance(field.dataType, (T.IntegerType, T.LongType))
            and isinstance(src, (T.DoubleType, T.FloatType, T.DecimalType))
        ):
            c = F.bround(c, 0)
        cols.append(c.cast(field.dataType).alias(field.name))
    return df.select(*cols)
