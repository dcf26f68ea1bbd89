"""The four dimensions: datetime, location, payment, passenger.

Ids are dense and ordered by the business key (ascending, NULLs first), so
they are stable over runs. ``grain="per_row"`` keeps one row per trip (the
SQL lane's datetime dimension has no GROUP BY); ``grain="distinct"`` keeps one
row per distinct key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.dates import datetime_parts
from starmart.functions.payment import (
    LOCATION_NAME,
    decode_payment_description,
    decode_payment_name,
)
from starmart.operators.keys import dense_key
from starmart.schema import COORD_COLUMNS

_PAIR = ["pickup_datetime", "dropoff_datetime"]


def check_grain(grain: str) -> None:
    if grain not in ("distinct", "per_row"):
        raise ValueError(f"grain must be 'distinct' or 'per_row', not {grain!r}")


def datetime_dim(
    trips: DataFrame,
    grain: str = "distinct",
    week_start: str = "sunday",
    dropoff_parts: bool = True,
    first_id: int = 1,
) -> DataFrame:
    """Datetime dimension keyed by the (pickup, dropoff) pair."""
    check_grain(grain)
    base = trips.select(*_PAIR)
    if grain == "distinct":
        base = base.distinct()
    keyed = dense_key(base, _PAIR, name="datetime_id", first_id=first_id, unique=grain == "distinct")
    return datetime_columns(keyed, week_start, dropoff_parts)


def datetime_columns(keyed: DataFrame, week_start: str = "sunday", dropoff_parts: bool = True) -> DataFrame:
    """The dimension's columns of numbered timestamp pairs."""
    cols = ["datetime_id", "pickup_datetime", *datetime_parts("pickup_datetime", "pickup", week_start)]
    if dropoff_parts:
        cols += ["dropoff_datetime", *datetime_parts("dropoff_datetime", "dropoff", week_start)]
    return keyed.select(*cols)


def location_dim(trips: DataFrame, grain: str = "distinct", name: str = LOCATION_NAME, first_id: int = 1) -> DataFrame:
    """Location dimension keyed by the four coordinates, plus a constant name."""
    check_grain(grain)
    base = trips.select(*COORD_COLUMNS)
    if grain == "distinct":
        base = base.distinct()
    return location_columns(dense_key(base, COORD_COLUMNS, name="location_id", first_id=first_id, unique=grain == "distinct"), name)


def location_columns(keyed: DataFrame, name: str = LOCATION_NAME) -> DataFrame:
    """The dimension's columns of numbered coordinates."""
    return keyed.select(
        "location_id",
        *COORD_COLUMNS,
        F.lit(name).alias("pickup_location_name"),
        F.lit(name).alias("dropoff_location_name"),
    )


def payment_dim(trips: DataFrame, decode: bool = True, first_id: int = 1) -> DataFrame:
    """One row per distinct payment code (NULL is a member).

    ``decode=True``: ``payment_type`` as text plus decoded name and
    description. ``decode=False``: ``payment_name`` holds the raw code.
    """
    codes = trips.select("payment_type").distinct()
    return payment_columns(dense_key(codes, ["payment_type"], name="payment_id", first_id=first_id), decode)


def payment_columns(keyed: DataFrame, decode: bool = True) -> DataFrame:
    """The dimension's columns of numbered payment codes."""
    if not decode:
        return keyed.select("payment_id", F.col("payment_type").alias("payment_name"))
    return keyed.select(
        "payment_id",
        F.col("payment_type").cast("string").alias("payment_type"),
        decode_payment_name("payment_type").alias("payment_name"),
        decode_payment_description("payment_type").alias("payment_description"),
    )


def passenger_dim(trips: DataFrame, first_id: int = 1) -> DataFrame:
    """One row per distinct passenger count (NULL is a member)."""
    counts = trips.select("passenger_count").distinct()
    return dense_key(counts, ["passenger_count"], name="passenger_id", first_id=first_id)
