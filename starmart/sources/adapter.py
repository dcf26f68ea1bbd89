"""Trips derived from the driver's ``lineitem`` and ``orders`` tables.

There is no trips table in the test data, so trips are computed from
``lineitem JOIN orders`` with expressions that every engine evaluates alike:
each double is a multiple of a power of two, so sums are exact in any order.
The join is a plain equi-join on the order key (sort-merge at scale; only the
order date is read from ``orders``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schema import TRIPS_COORD, TRIPS_ZONE


def _secs(n: Column) -> Column:
    return n.cast("int")


def _trip_columns() -> dict[str, Column]:
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    pickup = F.timestamp_add("SECOND", _secs((k * 7919 + ln * 613) % 86400), F.col("o_orderdate"))
    fare = F.floor(F.col("l_extendedprice")) / F.lit(1024.0)
    tip = (ln % 5) * F.lit(0.5)
    return {
        "pickup_datetime": pickup,
        "dropoff_datetime": F.timestamp_add("SECOND", _secs(F.lit(300) + (k % 40) * 60), pickup),
        "passenger_count": F.when(ln == 7, F.lit(None)).otherwise(ln).cast("int"),
        "trip_distance": F.col("l_quantity") * F.lit(0.25),
        "fare_amount": fare,
        "tip_amount": tip,
        "total_amount": fare + tip + F.lit(0.5),
        "payment_type": (F.lit(1) + sk % 5).cast("long"),
        "pickup_location_id": (F.lit(1) + sk % 263).cast("long"),
        "dropoff_location_id": (F.lit(1) + pk % 263).cast("long"),
        "pickup_latitude": F.lit(40.5) + (sk % 20) * F.lit(0.015625),
        "pickup_longitude": F.lit(-74.25) + (sk % 16) * F.lit(0.03125),
        "dropoff_latitude": F.lit(40.5) + (pk % 20) * F.lit(0.015625),
        "dropoff_longitude": F.lit(-74.25) + (pk % 16) * F.lit(0.03125),
    }


_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*_LINEITEM_COLS)
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def trips_from_tables(spark: SparkSession, sf_dir: str, variant: str = "coords") -> DataFrame:
    """All trips of ``sf_dir`` with the coordinate (``"coords"``) or zone
    (``"zones"``) schema."""
    schema = {"coords": TRIPS_COORD, "zones": TRIPS_ZONE}[variant]
    cols = _trip_columns()
    return _lineitem_orders(spark, sf_dir).select(
        *[cols[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    )


# Fixed value: the source names of the zone lane's columns.
_ZONE_SOURCE_NAMES = {
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
}

# The month split: every trip whose order date is before this falls in the
# first "file", every other trip in the second. Together they hold all trips.
MONTH_SPLIT = "1998-01-01"


def zone_months_from_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All trips split into two raw "monthly files" as the zone lane receives
    them: source column names, codes as doubles, and one extra column that
    only the first file carries."""
    cols = _trip_columns()
    joined = _lineitem_orders(spark, sf_dir)
    raw = [
        cols[f.name].cast("double" if f.name in ("passenger_count", "payment_type") else f.dataType)
        .alias(_ZONE_SOURCE_NAMES.get(f.name, f.name))
        for f in TRIPS_ZONE.fields
    ]
    in_first = F.coalesce(F.col("o_orderdate") < F.lit(MONTH_SPLIT).cast("timestamp_ntz"), F.lit(False))
    first = joined.where(in_first)
    second = joined.where(~in_first)
    first = first.select(*raw, F.lit(0.0).alias("airport_fee"))
    second = second.select(*raw)
    return first, second
