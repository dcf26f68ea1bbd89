"""Data-quality checks as queries returning ``(check, column, failures)``.

Every check is a distributed query (an aggregate, a grouped aggregate, or an
anti join after a pre-aggregate) whose result has one row per checked column;
only those rows are brought to the driver, and only by ``run_checks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.checkpoint import read_from_files
from starmart.jobs import concurrently
from starmart.operators.joins import lookup_join
from starmart.sources.trips import require_columns  # noqa: F401  (re-exported)

# The key fields and non-negative measures the zone lane checks.
ZONE_KEY_FIELDS = ["trip_id", "datetime_id", "pickup_location_id", "dropoff_location_id", "payment_id", "passenger_id"]
NON_NEGATIVE_FIELDS = ["trip_distance", "trip_duration", "fare_amount"]

# Fact foreign key -> the dimension it references (whose key has the same name).
STAR_FOREIGN_KEYS = {
    "datetime_id": "dim_datetime",
    "location_id": "dim_location",
    "payment_id": "dim_payment",
    "passenger_id": "dim_passenger",
}


class CheckFailed(ValueError):
    """Raised by ``run_checks`` with every failing (check, column, count)."""

    def __init__(self, failures: list[tuple[str, str, int]]):
        self.failures = failures
        detail = ", ".join(f"{c}({col})={n}" for c, col, n in failures)
        super().__init__(f"Data-quality checks failed: {detail}")


def _long_form(df: DataFrame, check: str, counts: Mapping[str, object]) -> DataFrame:
    """One aggregate row of named counts -> rows (check, column, failures)."""
    entries = [F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), e.cast("long").alias("failures"))
               for c, e in counts.items()]
    return df.agg(F.array(*entries).alias("_r")).select(F.inline("_r"))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL (or NaN) values per column."""
    counts = {}
    for c in columns:
        cond = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            cond = cond | F.isnan(c)
        counts[c] = F.count_if(cond)
    return _long_form(df, "not_null", counts)


def check_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values below zero per column (NULL and NaN do not count)."""
    counts = {c: F.count_if(F.col(c) < 0) for c in columns}
    return _long_form(df, "non_negative", counts)


def key_runs(df: DataFrame, key: str) -> DataFrame:
    """How each part of ``df`` that one task reads of one file holds its keys:
    ``low``, ``high``, ``n``, ``nulls`` and ``run``, whether they are consecutive in the
    order they stand. No key is shuffled: a task sends one row for each file it reads.

    Keys numbered where they stand (``dense_key``, ``number_both``) are such runs: key less
    position is one number there.
    """
    place = F.monotonically_increasing_id()
    part = df.select(
        F.col(key).cast("long").alias("k"), place.alias("at"), F.input_file_name().alias("file"), F.spark_partition_id().alias("task")
    )
    step = F.col("k") - F.col("at")
    return part.groupBy("file", "task").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count("k").alias("n"), F.count_if(F.col("k").isNull()).alias("nulls"),
        (F.min(step) == F.max(step)).alias("run"),
    )


def _unproven(df: DataFrame, key: str) -> DataFrame:
    """One row: ``unproven``, false if the runs' borders show that no key repeats."""
    # One row for each file and task that reads it: a few numbers, as many as scan tasks.
    before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    runs = key_runs(df, key).where("n > 0").withColumn("meets", F.coalesce(F.max("high").over(before) >= F.col("low"), F.lit(False)))
    return runs.agg((F.count_if(F.col("meets") | ~F.col("run")) > 0).alias("unproven"))


def check_unique(df: DataFrame, key: str, table: str | None = None) -> DataFrame:
    """Primary-key check: rows sharing a non-NULL key with an earlier row
    (``unique``) and NULL keys (``not_null``).

    Whole-number keys that were numbered where they stand are proved unique from
    borders: consecutive inside every part of a file, and the parts' ranges disjoint. Only
    if that proof fails (a subquery evaluated once) do keys go through a shuffle, where
    grouping by the key pre-aggregates on the map side, so a key repeated by a
    third of the table is collapsed before.
    """
    label = f"{table}.{key}" if table else key
    doubtful = df.select(key)
    nulls = df.agg(F.count_if(F.col(key).isNull()).alias("_nulls"))
    if isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType)) and read_from_files(df):
        doubtful = doubtful.where(_unproven(df, key).scalar())
    per_key = doubtful.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("_repeats")).select(
        F.array(
            F.struct(F.lit("unique").alias("check"), F.lit(label).alias("column"), F.col("_repeats").alias("failures")),
            F.struct(F.lit("not_null").alias("check"), F.lit(label).alias("column"), nulls.scalar().cast("long").alias("failures")),
        ).alias("_r")
    ).select(F.inline("_r"))


def _unmatched(fact: DataFrame, fk: str, ids: DataFrame, key: str) -> DataFrame:
    """One row: ``unproven``, false if borders show that every ``fk`` has a row in ``ids``: the
    runs of ``key`` follow each other without a gap, and all of ``fk`` lies between their ends."""
    before = Window.orderBy("low", "high")
    gap = F.coalesce(F.lag("high").over(before) + 1 != F.col("low"), F.lit(False))
    whole = F.col("run") & (F.col("high") - F.col("low") + 1 == F.col("n"))
    # One row for each file and task that reads it.
    runs = key_runs(ids, key).where("n > 0").withColumn("broken", gap | ~whole)
    have = runs.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count_if("broken").alias("broken"))
    asked = fact.agg(F.min(fk).alias("first"), F.max(fk).alias("last"))
    held = (F.col("broken") == 0) & (F.col("low") <= F.col("first")) & (F.col("last") <= F.col("high"))
    return asked.crossJoin(have).select((F.col("first").isNotNull() & ~F.coalesce(held, F.lit(False))).alias("unproven"))


def check_orphans(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    foreign_keys: Mapping[str, str] = STAR_FOREIGN_KEYS,
    large: Sequence[str] = ("datetime_id",),
) -> DataFrame:
    """Facts whose non-NULL foreign key has no row in its dimension.

    The keys not in ``large`` are counted together in one scan of the fact (a
    map-side pre-aggregate by their combinations); each large one is counted
    per value in a scan of its own. Only distinct values are anti-joined.

    For a large key whose dimension was numbered where it stands, borders prove that no fact is an
    orphan (``_unmatched``); only if they don't are values and ids shuffled.
    """
    own = [k for k in foreign_keys if k in large]
    together = [k for k in foreign_keys if k not in large]
    parts = []
    for fk in own:
        ids = dims[foreign_keys[fk]].select(F.col(fk).alias("_k_id"))
        doubtful = fact.select(fk).where(F.col(fk).isNotNull())
        whole = (T.LongType, T.IntegerType)
        if isinstance(ids.schema["_k_id"].dataType, whole) and isinstance(fact.schema[fk].dataType, whole) and read_from_files(ids) and read_from_files(fact):
            unproven = _unmatched(fact, fk, ids, "_k_id")
            doubtful, ids = doubtful.where(unproven.scalar()), ids.where(unproven.scalar())
        per_value = doubtful.groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
        orphans = lookup_join(per_value, ids, [(fk, "_k_id")], "left_anti")
        parts.append(orphans.agg(F.sum("_n").alias("n")).select(F.lit(fk).alias("fk"), "n"))
    if together:
        combined = fact.groupBy(*together).agg(F.count(F.lit(1)).alias("_n"))
        each = F.array(*[F.struct(F.lit(k).alias("fk"), F.col(k).cast("long").alias("value")) for k in together])
        per_value = combined.select(F.explode(each).alias("_e"), "_n").select("_e.*", "_n").where("value is not null")
        per_value = per_value.groupBy("fk", "value").agg(F.sum("_n").alias("_n"))
        ids = reduce(DataFrame.unionAll, [
            dims[foreign_keys[k]].select(F.lit(k).alias("_fk"), F.col(k).cast("long").alias("_k_id")) for k in together
        ])
        orphans = lookup_join(per_value, ids, [("fk", "_fk"), ("value", "_k_id")], "left_anti")
        parts.append(orphans.groupBy("fk").agg(F.sum("_n").alias("n")))
    found = reduce(DataFrame.unionAll, parts)
    # One row per foreign key, also for those without an orphan.
    counts = {
        f"{fk}->{dim}": F.coalesce(F.sum(F.when(F.col("fk") == fk, F.col("n"))), F.lit(0)) for fk, dim in foreign_keys.items()
    }
    return _long_form(found, "orphans", counts)


def run_checks(results: Sequence[DataFrame] | DataFrame, raise_on_failure: bool = True) -> list[tuple[str, str, int]]:
    """Collect check results (a few rows each, concurrently); raise if any
    count is > 0."""
    frames = [results] if isinstance(results, DataFrame) else list(results)
    # Independent checks: their jobs run side by side (results in order).
    rows = [r for batch in concurrently(*[f.collect for f in frames]) for r in batch]
    failures = [(r["check"], r["column"], int(r["failures"])) for r in rows if r["failures"]]
    if failures and raise_on_failure:
        raise CheckFailed(failures)
    return [(r["check"], r["column"], int(r["failures"])) for r in rows]
