"""Joins against dimensions.

No size is counted and none is assumed: a dimension read from files whose
listed size is below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast by
the planner, one whose shuffled size turns out to be small is broadcast by AQE
from the measured bytes, and every other one is joined by shuffle (AQE splits
a skewed key's partition). Defining a join runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join ``df`` to ``dim`` on ``df[left] == dim[right]`` for each pair.

    ``null_safe=True`` compares with ``<=>`` (a NULL key finds the NULL member).
    """
    cond = None
    for left_col, right_col in pairs:
        a, b = df[left_col], dim[right_col]
        c = a.eqNullSafe(b) if null_safe else a == b
        cond = c if cond is None else cond & c
    return df.join(dim, cond, how)
