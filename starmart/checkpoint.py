"""Cutting lineage: write a DataFrame once to the shared checkpoint folder.

Used where a plan must be evaluated exactly once (ids that depend on a sampled
range partitioning, for instance). The folder is the one the cluster names in
``spark.checkpoint.dir``; nothing is written to a machine-local temp folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor can reach"
        )
    return root.rstrip("/")


# The innermost scope of the running context: threads of two runs don't share it.
_SCOPE: ContextVar[str] = ContextVar("starmart_scratch", default="")


def app_root(spark: SparkSession) -> str:
    """The folder new intermediate tables go to: this application's folder,
    or the innermost ``scratch_scope`` inside it."""
    base = f"{checkpoint_root(spark)}/starmart/{spark.sparkContext.applicationId}"
    return f"{base}/{_SCOPE.get()}" if _SCOPE.get() else base


#: Sorted ids and times as differences (Parquet's second page format), then zstd.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}


def materialize(df: DataFrame, label: str = "table", compact: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back;
    ``compact``, for tables as long as the input, in a form that takes less room.

    The result's lineage starts at the written files, so a lost executor
    re-reads them instead of recomputing (and possibly re-sampling) the plan.
    """
    spark = df.sparkSession
    path = f"{app_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**(COMPACT if compact else {})).parquet(path)
    # The schema is known: no job is needed to read it back from the footers.
    return spark.read.schema(df.schema).parquet(path)


def read_from_files(df: DataFrame) -> bool:
    """Whether ``df`` is a scan of files with at most projections and filters on it:
    reading it again costs no more, and gives each task's rows in the same order."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    costly = ("Exchange", "Sort", "Join", "Aggregate", "Python", "Pandas", "Arrow", "Generate", "Expand", "ExistingRDD", "LocalTableScan")
    return "FileScan" in plan and not any(x in plan for x in costly)


def delete_folder(spark: SparkSession, folder: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


@contextmanager
def scratch_scope(spark: SparkSession, release: bool = True) -> Iterator[str]:
    """Intermediate tables made inside the block go to their own folder,
    deleted when the block ends (``release``). Only DataFrames made inside the
    block read those files, so use them there."""
    token = _SCOPE.set(f"run-{uuid.uuid4().hex}")
    folder = app_root(spark)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        if release:
            delete_folder(spark, folder)
