"""Dense surrogate keys that do not funnel the data through one task.

``row_number()`` over an unpartitioned window moves every row to a single
partition. ``dense_key`` instead numbers rows the way a distributed
``zipWithIndex`` does, on DataFrames:

1. range-partition the rows by the sort key and sort inside each partition
   (Spark samples the key to pick balanced bounds);
2. tag every row with ``monotonically_increasing_id()``, whose upper bits are
   the partition index and lower 33 bits the position inside the partition;
3. write that once to the shared checkpoint folder, so sampling can never be
   re-run with different bounds (and a lost executor re-reads the files);
4. count rows per partition (one small column), turn the counts into running
   offsets (one number per partition, so bounded by the partition count,
   never by the data) and add ``offset + position`` in a plain projection.

When the sort key is not unique a hidden sequence number is appended, so even
a group of identical rows holding a third of the table is spread over many
range partitions instead of landing in one task. The number follows the files where
rows are read straight from them, else a local sort of each input partition
(no shuffle), which makes it the same on a task re-run.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.operators.onepass import SEQUENCE, ranges_of, with_sequence

_MID = "_sm_mid"
_PID = "_sm_pid"
_POS_BITS = 33


def dense_key(
    df: DataFrame,
    order_by: Sequence[str | Column] | None,
    name: str = "id",
    first_id: int = 1,
    unique: bool = True,
    num_partitions: int | None = None,
    keep: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Add a gap-free ``bigint`` key ``name`` numbering ``df``'s rows.

    ``order_by`` gives the numbering order (ascending, NULLs first). With
    ``order_by=None`` the rows are numbered in their current partition order,
    which needs no shuffle at all. ``unique=False`` declares that the key may
    repeat: tied rows then get consecutive ids in an unspecified order.
    The new column comes first. ``keep`` names the columns that are stored and returned (by
    default all); others are only sorted by.
    """
    staged = numbered(df, order_by, unique, num_partitions, keep)
    original = [c for c in staged.columns if c != _MID]
    stored = materialize(staged, "dense-key", compact=True)

    # Rows per written partition: one small column is scanned, and the result
    # has one row per partition (bounded by the partition count, never by the
    # data), so it is brought to the driver and inlined as a literal array.
    pid = F.shiftright(F.col(_MID), _POS_BITS)
    counts = dict(stored.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("n")).collect())
    n_parts = (max(counts) + 1) if counts else 0
    starts, running = [], first_id
    for p in range(n_parts):
        starts.append(running)
        running += counts.get(p, 0)
    position = F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    if starts:
        # One literal for all offsets, however many partitions there are.
        start = F.element_at(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), (pid + 1).cast("int"))
    else:
        start = F.lit(first_id).cast("long")
    return stored.select((start + position).cast("long").alias(name), *original)


def numbered(
    df: DataFrame,
    order_by: Sequence[str | Column] | None,
    unique: bool = True,
    num_partitions: int | None = None,
    keep: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The rows of ``df`` in key order across partitions, each tagged with
    ``monotonically_increasing_id()`` (partition index, position): what
    ``dense_key`` writes once before turning the tags into ids."""
    original = df.columns
    staged = df
    if order_by:
        num_partitions = num_partitions or ranges_of(df)
        keys: list[str | Column] = list(order_by)
        if not unique:
            # Number rows inside each input partition, in the order of the files or after a
            # local sort by every column: a re-run task (lost executor) then assigns
            # the same (row, number) pairs, since equal rows are interchangeable.
            staged = with_sequence(staged, original)
            keys.append(SEQUENCE)
        staged = (
            staged.repartitionByRange(num_partitions, *keys)
            if num_partitions
            else staged.repartitionByRange(*keys)
        ).sortWithinPartitions(*keys)
    else:
        # Positions follow a local sort, so a re-run task numbers alike.
        staged = staged.sortWithinPartitions(*original)
    staged = staged.select(*(keep or original), F.monotonically_increasing_id().alias(_MID))
    return staged
