"""Writing tables and exporting marts, profiles and reports.

Writers are Spark writers: every task writes its own part file in parallel.
``single_file=True`` sends a result through one task: the caller's choice, for
marts and reports that are small by construction.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from starmart.jobs import inheriting
from starmart.schema import conform


def save(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Write a table. ``mode``: ``overwrite`` (idempotent reruns, the
    default), ``append``, ``ignore`` (create only if absent) or ``error``."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, mode: str = "overwrite"
) -> None:
    """Write a catalog table at ``path``, bucketed and sorted by ``key``.

    Two tables bucketed alike on a join key are joined later without a
    shuffle on either side (and grouped by that key without one).
    """
    (
        df.write.mode(mode)
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def save_table_with_schema(df: DataFrame, path: str, schema: T.StructType, mode: str = "append", fmt: str = "parquet") -> None:
    """Append (or write) ``df`` into a table of declared ``schema``: columns
    are selected by name in schema order and cast explicitly."""
    save(conform(df, schema), path, mode=mode, fmt=fmt)


def export_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[Column] | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """CSV with a header row and no index column, optionally sorted: one sorted
    file, or range-partitioned parts whose names follow the order."""
    if single_file:
        out = df.repartition(1)
        out = out.sortWithinPartitions(*order_by) if order_by else out
    else:
        out = df.orderBy(*order_by) if order_by else df
    out.write.mode(mode).option("header", True).csv(path)


def export_json(
    df: DataFrame,
    path: str,
    single_file: bool = True,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """JSON lines, NULL fields written as ``null`` (not dropped).

    A DataFrame whose only data column is a string ``json`` (as built by the
    profile and report functions) is written as that text. ``partition_by`` writes one folder
    per value (one document per mart, say) in a single job.
    """
    out = df.repartition(1) if single_file else df
    data_cols = [c for c in out.columns if c not in (partition_by or [])]
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if data_cols == ["json"] and isinstance(out.schema["json"].dataType, T.StringType):
        w.text(path)
    else:
        w.option("ignoreNullFields", False).json(path)


def export_all(
    marts: Mapping[str, DataFrame | Callable[[], DataFrame]],
    out_dir: str,
    order: Mapping[str, Sequence[Column]] | None = None,
    on_error: str = "raise",
    single_file: bool = False,
    after: Callable[[str, DataFrame], None] | None = None,
) -> dict[str, str]:
    """Export every mart to ``out_dir/<name>.csv``; returns status per mart. A
    mart given as a builder is built here, so that a failure to build it falls under
    the policy too, and so does ``after``, which gets each mart once it is written.

    The exports run concurrently. ``on_error="raise"`` raises the first
    failure in mart order; ``"skip"`` records each error text and keeps the
    other exports.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")

    def one(name: str, mart) -> None:
        df = mart() if callable(mart) else mart
        export_csv(df, f"{out_dir}/{name}.csv", (order or {}).get(name), single_file=single_file)
        if after:
            after(name, df)

    # Independent exports run as concurrent Spark jobs from a few threads.
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(marts)))) as pool:
        futures = {name: pool.submit(inheriting(one), name, mart) for name, mart in marts.items()}
        status: dict[str, str] = {}
        for name, fut in futures.items():  # mart order, so the first failure is the first mart's
            exc = fut.exception()
            if exc is None:
                status[name] = "ok"
            elif on_error == "raise":
                raise exc
            else:
                status[name] = f"error: {exc}"
    return status
