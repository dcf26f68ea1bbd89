"""Trip ids and datetime ids from one range pass, borders carried over.

Trips sorted by all their columns are also sorted by (pickup, dropoff), so the
order that numbers the facts numbers the distinct timestamp pairs as well. The
rows are range-partitioned once, sorted, and read through once in partition
order; a row gets the number of its pair in its partition and, if it is a fact, its
own number among the partition's facts. Written once, they never change.

A pair may go on from one partition to the next. Each partition therefore reports
its borders: first and last pair, how many pairs, how many facts (one row for a
partition, whatever the data). A running sum over those, less one wherever a
partition goes on with the pair before it, turns the numbers into ids. Dimension
and facts are then plain projections of the stored rows: no join of facts with
the datetime dimension, and no second sort.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.checkpoint import materialize, read_from_files

SEQUENCE = "_sm_seq"
_PID, _GROUP, _OPENS, _ROW, _COUNTS = "_sm_pid", "_sm_group", "_sm_opens", "_sm_row", "_sm_counts"


def with_sequence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with a number that tells equal rows apart, so that they spread over
    ranges. It must be the same when a task runs again: rows read straight from
    files keep their order, others are sorted first."""
    return (df if read_from_files(df) else df.sortWithinPartitions(*columns)).withColumn(SEQUENCE, F.monotonically_increasing_id())


#: Bytes of the files that are read, as Parquet holds them, that one range of a sort stands for.
RANGE_BYTES = 16 << 20


def ranges_of(df: DataFrame) -> int | None:
    """How many ranges the rows of ``df`` are sorted in, so that a sorted range stays small
    however long the input is; None where the session's number of partitions (which adaptive execution
    may merge) will do, and where ``df`` is more than a scan of files."""
    if not read_from_files(df):
        return None
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(-(-size // RANGE_BYTES), 20_000)
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _numbered(group: Sequence[str], counts: str):
    """The map over a sorted partition: adds the number of the row's group, whether
    it opens it here, and the row's number among those that count (null: it doesn't)."""

    def same(a: pa.Array, b: pa.Array) -> np.ndarray:
        """Row by row, equal or both null."""
        equal = pc.fill_null(pc.equal(a, b), False)
        return pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, groups, rows = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(b.schema.get_field_index(g)) for g in group]
            opens = np.ones(b.num_rows, dtype=bool)
            opens[1:] = ~np.logical_and.reduce([same(k.slice(1), k.slice(0, len(k) - 1)) for k in keys])
            if last is not None:
                opens[0] = not all(same(k.slice(0, 1), v)[0] for k, v in zip(keys, last, strict=True))
            last = [k.slice(len(k) - 1, 1) for k in keys]
            number = np.cumsum(opens) + groups - 1
            own = b.column(b.schema.get_field_index(counts)).to_numpy(zero_copy_only=False).astype(bool)
            place = np.cumsum(own) + rows - 1
            groups, rows = int(number[-1]) + 1, int(place[-1]) + 1
            names = [n for n in b.schema.names if n != counts]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(n)) for n in names], pa.array(number), pa.array(opens), pa.array(place, mask=~own)],
                names=[*names, _GROUP, _OPENS, _ROW],
            )

    return run


def number_both(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    counts: str | Column,
    keep: Sequence[str],
    group_id: str,
    row_id: str,
    first_id: int = 1,
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): ``df`` in the order of ``order`` (which begins with the
    columns ``group``; ascending, NULLs first), ``group_id`` the dense rank of each row's
    group among all rows, ``row_id`` a gap-free number over the rows for which the
    boolean ``counts`` holds (an expression is evaluated behind the shuffle). ``rows`` has the rows that count; ``groups`` has
    one row (``group_id`` and the columns ``group``) for each group of all rows. Rows equal
    in ``order`` get consecutive ids. ``keep`` names the columns ``rows`` has besides the
    ids; others are only sorted by. ``df`` must have the column of ``with_sequence``.
    """
    if list(order[: len(group)]) != list(group):
        raise ValueError("the order must begin with the group's columns")
    keys = [*order, SEQUENCE]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    wanted = list(dict.fromkeys([*group, *keep]))
    ranged = ranged.sortWithinPartitions(*keys).select(*wanted, (F.col(counts) if isinstance(counts, str) else counts).alias(_COUNTS))
    kept = [ranged.schema[c] for c in wanted]
    schema = T.StructType([*kept, T.StructField(_GROUP, T.LongType()), T.StructField(_OPENS, T.BooleanType()), T.StructField(_ROW, T.LongType())])
    walked = ranged.mapInArrow(_numbered(group, _COUNTS), schema)
    stored = materialize(walked.withColumn(_PID, F.spark_partition_id()), "one-pass", compact=True)

    # Borders: one row for each written partition.
    pair = F.struct(*group)
    borders = stored.groupBy(_PID).agg(
        F.min_by(pair, _GROUP).alias("first"), F.max_by(pair, _GROUP).alias("last"),
        (F.max(_GROUP) + 1).alias("groups"), F.count(_ROW).alias("rows"),
    ).collect()
    groups_at, rows_at, goes_on = _offsets(borders)
    n = max(groups_at, default=-1) + 1
    start = lambda at: F.element_at(
        F.from_json(F.lit(json.dumps([at.get(p, 0) + first_id for p in range(n)])), "array<bigint>"), F.col(_PID) + 1
    )
    gid = (start(groups_at) + F.col(_GROUP)).cast("long").alias(group_id) if n else F.lit(first_id).cast("long").alias(group_id)
    rid = (start(rows_at) + F.col(_ROW)).cast("long").alias(row_id) if n else F.lit(first_id).cast("long").alias(row_id)
    rows = stored.where(F.col(_ROW).isNotNull()).select(rid, gid, *keep)
    # A group that goes on from the partition before was opened there.
    on = F.element_at(F.from_json(F.lit(json.dumps([p in goes_on for p in range(n)])), "array<boolean>"), F.col(_PID) + 1) if n else F.lit(False)
    groups = stored.where(F.col(_OPENS) & ~((F.col(_GROUP) == 0) & on)).select(gid, *group)
    return rows, groups


def _offsets(borders: list) -> tuple[dict[int, int], dict[int, int], set[int]]:
    """Groups and rows before each partition, and the partitions that go on with
    the group before them (whose first group is the one before's last)."""
    groups_at, rows_at, goes_on = {}, {}, set()
    groups = rows = 0
    last = None
    for b in sorted(borders, key=lambda b: b[_PID]):
        if last is not None and b["first"] == last:
            goes_on.add(b[_PID])
            groups -= 1
        groups_at[b[_PID]], rows_at[b[_PID]] = groups, rows
        groups, rows, last = groups + b["groups"], rows + b["rows"], b["last"]
    return groups_at, rows_at, goes_on
