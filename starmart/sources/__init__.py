"""Readers for trip records and the adapter over the driver's tables."""

from starmart.sources.adapter import trips_from_tables, zone_months_from_tables
from starmart.sources.staging import stage
from starmart.sources.trips import (
    normalize,
    read_trips_csv,
    read_trips_parquet,
    require_columns,
    union_months,
)

__all__ = [
    "normalize",
    "read_trips_csv",
    "read_trips_parquet",
    "require_columns",
    "union_months",
    "stage",
    "trips_from_tables",
    "zone_months_from_tables",
]
