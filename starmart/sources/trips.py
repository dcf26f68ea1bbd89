"""Reading trips from CSV or Parquet and normalising their columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schema import TRIPS_COORD, TRIPS_ZONE, ZONE_RENAMES


class MissingColumnsError(ValueError):
    """Raised when required input columns are absent; lists them in order."""

    def __init__(self, missing: list[str]):
        self.missing = missing
        super().__init__(f"Missing required columns: {missing}")


def require_columns(columns: Iterable[str], required: Sequence[str]) -> None:
    """Raise ``MissingColumnsError`` naming every required column not present.

    Works on the schema only (``df.columns``): no job runs.
    """
    present = set(columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise MissingColumnsError(missing)


def read_trips_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = TRIPS_COORD) -> DataFrame:
    """CSV with a header row, read with an explicit schema (never inferred).

    The header is checked against ``schema`` first, from the file's first line
    only; a missing path raises ``PATH_NOT_FOUND`` before any work; a value
    that does not parse (a malformed timestamp, say) fails the read.
    """
    header = spark.read.option("header", True).csv(path).columns
    require_columns(header, schema.fieldNames())
    # FAILFAST: a value that does not parse as its declared type is an error,
    # not a silent NULL.
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .schema(_csv_read_schema(header, schema))
        .csv(path)
    )
    return raw.select(*[_stored(raw, f) for f in schema.fields])


def _stored(df: DataFrame, field: T.StructField) -> Column:
    """A column cast to its declared type. Counts and codes may come as whole
    doubles or decimals (NaN: missing); a fraction is an error, not cut off."""
    c, kind = F.col(field.name), df.schema[field.name].dataType
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), None).otherwise(c)
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            fault = F.raise_error(F.concat(F.lit(f"{field.name} is not a whole number: "), c.cast("string")))
            c = F.when(c != F.floor(c), fault).otherwise(c)
    return c.cast(field.dataType).alias(field.name)


def _csv_read_schema(header: list[str], schema: T.StructType) -> T.StructType:
    # Read in file column order; columns outside the schema are read as strings
    # and dropped by the final select. Codes may be written as "1.0": read as
    # decimals (a double would lose digits of large codes), then cast.
    by_name = {f.name: f.dataType for f in schema.fields}
    fields = []
    for name in header:
        t = by_name.get(name, T.StringType())
        if isinstance(t, (T.LongType, T.IntegerType)):
            t = T.DecimalType(38, 6)
        fields.append(T.StructField(name, t, True))
    return T.StructType(fields)


def parquet_schemas(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The paths by schema, as few groups as they need: files whose schemas merge
    (columns that only some have, say) are one group, with the merged schema.

    The footers of a whole group are merged by one distributed job. Where types
    differ Spark refuses, and the group is halved: with a few changes of type in a long
    series of months that takes a few jobs a change, not one a file. Groups that turn out
    to have equal types are put together again, wherever they stood.
    """
    found: dict[str, tuple[T.StructType, list[str]]] = {}

    def types_of(schema: T.StructType) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in schema.fields}

    def group(some: list[str]) -> None:
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*some).schema
        except Exception as e:  # raised in a task, so its condition is only in the text
            if len(some) == 1 or "[CANNOT_MERGE" not in str(e):
                raise
            group(some[: len(some) // 2])
            group(some[len(some) // 2 :])
            return
        mine = types_of(schema)
        for k, (other, held) in found.items():
            theirs = types_of(other)
            if all(theirs.get(name, kind) == kind for name, kind in mine.items()):
                merged = T.StructType([*other.fields, *[f for f in schema.fields if f.name not in theirs]])
                found[k] = (merged, held + some)
                return
        found[str(len(found))] = (schema, list(some))

    group(list(paths))
    return list(found.values())


def read_trips_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read Parquet files or folders (months) as one DataFrame, by name: one scan
    for each distinct set of column types, however many paths there are. A
    column that a file lacks is NULL there; where types differ (whole numbers in one month,
    doubles in another), the wider one holds, and ``normalize`` gives columns their declared types."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("read_trips_parquet needs at least one path")
    return union_months([spark.read.schema(schema).parquet(*some) for schema, some in parquet_schemas(spark, paths)])


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column missing on one side is NULL.

    Duplicates are kept (UNION ALL).
    """
    if not frames:
        raise ValueError("union_months needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def normalize(
    df: DataFrame,
    rename: Mapping[str, str] = ZONE_RENAMES,
    schema: T.StructType = TRIPS_ZONE,
) -> DataFrame:
    """Rename (unlisted columns untouched, absent ones ignored), check that
    every column of ``schema`` is present, then select them in order and cast.

    Timestamps are parsed with ANSI casts, so a malformed value raises.
    """
    renamed = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns and k != v})
    require_columns(renamed.columns, schema.fieldNames())
    return renamed.select(*[_stored(renamed, f) for f in schema.fields])
