"""The staging table: trips written once, then read by every star step.

Building a star reads the trips five times (four dimensions and the fact).
Writing them once to the shared checkpoint folder means the source (a CSV
parse, or a join of raw tables) runs once; later passes read only the Parquet
columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.checkpoint import materialize


def stage(trips: DataFrame, label: str = "staging", partitions: int | None = None) -> DataFrame:
    """Materialize ``trips`` and return the re-read table.

    ``partitions`` deals the rows out evenly over so many files first: worth a
    shuffle where the input is one file that a single task would read. Without
    it the table is written as it comes.
    """
    if partitions:
        trips = trips.repartition(partitions)
    return materialize(trips, label, compact=True)
