"""Column profile of a table: row count, columns, NULL counts and, for numeric
columns, min / max / mean / median (NaN is treated as NULL throughout).

The long form has one row per column. Nothing is sorted. One aggregate over the
table (a row per task, whatever its size) gives every figure but the median, and a
sketch's values a little below and above the middle. The exact median is then
*selected*: a second aggregate counts what lies below that bracket and keeps only the
values inside it, each with its count. A bracket that still holds many values is
cut to the bins its middle ranks fall into, again and again, until a few
values are left. The sketch only makes the bracket narrow: should a middle rank lie
outside, the bracket is widened to that side, so the median is exact whatever the data.

A table that isn't read straight from files is stored first, so the profiled query
runs once. ``median="approx"`` takes the sketch's median and no second aggregate.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.checkpoint import materialize, read_from_files
from starmart.jobs import concurrently

PROFILE_COLUMNS = ["column", "ordinal", "row_count", "null_count", "min", "max", "mean", "median"]

#: Values of a bracket that are brought to the driver, and bins a wider one is cut into.
FEW = 4096
BINS = 1024


def _is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def _is_null(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    return c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def _value(f: T.StructField) -> Column:
    """The column as a double, NaN mapped to NULL (and -0.0 to 0.0)."""
    return F.when(~_is_null(f), F.col(f"`{f.name}`").cast("double") + F.lit(0.0))


def _figures(df: DataFrame, accuracy: int) -> dict:
    """The first aggregate: rows, and by ordinal NULLs, values and their figures."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    # The sketch's ranks are off by 1 / accuracy of the rows at most.
    marks = [max(0.0, 0.5 - 2 / accuracy), 0.5, min(1.0, 0.5 + 2 / accuracy)]
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.count_if(_is_null(f)).alias(f"nulls_{i}"))
        if _is_numeric(f.dataType):
            v = _value(f)
            aggs += [F.count(v).alias(f"n_{i}"), F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}"), F.avg(v).alias(f"mean_{i}"),
                     F.percentile_approx(v, marks, accuracy).alias(f"marks_{i}")]
    return df.agg(*aggs).first().asDict()


def _select(df: DataFrame, wanted: dict[int, tuple[int, float, float]]) -> dict[int, float]:
    """The median of each wanted column: ordinal to (values, low, high), the ends
    of a first bracket. Jobs: one over the table, then one for each cut of the brackets."""
    fields = df.schema.fields
    while True:
        entries = F.array(*[
            F.struct(F.lit(i).alias("i"), F.when(_value(fields[i]) < low, F.lit(float("-inf"))).otherwise(_value(fields[i])).alias("v"),
                     (_value(fields[i]) < low).alias("below"))
            for i, (_, low, high) in wanted.items()
        ])
        highs = {i: high for i, (_, _, high) in wanted.items()}
        cells = df.select(F.explode(entries).alias("e")).select("e.*")
        inside = F.lit(False)
        for i, high in highs.items():
            inside = inside | ((F.col("i") == i) & (F.col("v") <= high))
        # What lies below is one value for each column; equal values are counted in tasks first.
        kept = materialize(
            cells.where(F.col("v").isNotNull() & inside).groupBy("i", "below", "v").agg(F.count(F.lit(1)).alias("n")), "profile-bracket"
        )
        held = {r["i"]: r for r in kept.groupBy("i").agg(
            F.sum(F.when(F.col("below"), F.col("n")).otherwise(0)).alias("below"), F.sum("n").alias("upto")).collect()}
        wrong = {}
        for i, (n, low, high) in wanted.items():
            first, last = (n - 1) // 2, n // 2
            below, upto = (held[i]["below"], held[i]["upto"]) if i in held else (0, 0)
            if first < below or last >= upto:
                wrong[i] = (n, -math.inf if first < below else low, math.inf if last >= upto else high)
        if not wrong:
            return _narrowed(kept.where("not below"), {
                i: ((n - 1) // 2 - held[i]["below"], n // 2 - held[i]["below"]) for i, (n, _, _) in wanted.items()
            })
        wanted = {i: wrong.get(i, w) for i, w in wanted.items()}


def _narrowed(values: DataFrame, ranks: dict[int, tuple[int, int]]) -> dict[int, float]:
    """The mean of the values at two ranks (from 0) of each column; ``values`` has
    each distinct value ``v`` of column ``i`` once, with its count ``n``."""
    out: dict[int, float] = {}
    while ranks:
        stats = {r["i"]: r for r in values.groupBy("i").agg(F.count(F.lit(1)).alias("k"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
        small = [i for i in ranks if stats[i]["k"] <= FEW]
        if small:
            found: dict[int, list] = {i: [] for i in small}
            for r in values.where(F.col("i").isin(small)).collect():
                found[r["i"]].append((r["v"], r["n"]))
            for i in small:
                out[i] = _between(sorted(found[i]), *ranks.pop(i))
        if not ranks:
            return out
        # Bins of equal width, in halves so that no difference overflows.
        number = F.lit(None).cast("int")
        for i in ranks:
            low, high = stats[i]["low"], stats[i]["high"]
            low, high = max(low, -1.7e308), min(high, 1.7e308)
            part = (F.col("v") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2) * BINS
            clipped = F.greatest(F.lit(0.0), F.least(F.lit(float(BINS - 1)), F.floor(part).cast("double")))
            infinite = F.when(F.col("v") < low, -1).when(F.col("v") > high, BINS)
            number = F.when(F.col("i") == i, F.coalesce(infinite, clipped.cast("int"))).otherwise(number)
        binned = values.where(F.col("i").isin(list(ranks))).withColumn("b", number)
        counts: dict[int, list] = {i: [] for i in ranks}
        for r in binned.groupBy("i", "b").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect():
            counts[r["i"]].append((r["b"], r["n"], r["low"], r["high"]))
        keep = F.lit(False)
        for i, (first, last) in list(ranks.items()):
            seen, hit = 0, []
            for b, n, low, high in sorted(counts[i]):
                if seen <= last and first < seen + n:
                    hit.append((b, seen, low, high))
                seen += n
            if len(hit) > 1:
                # Neighbours in rank, so the last of one bin and the first of the next.
                out[i] = (hit[0][3] + hit[-1][2]) / 2
                del ranks[i]
            else:
                b, seen, _, _ = hit[0]
                ranks[i] = (first - seen, last - seen)
                keep = keep | ((F.col("i") == i) & (F.col("b") == b))
        values = materialize(binned.where(keep).drop("b"), "profile-bracket")
    return out


def _between(values: list[tuple[float, int]], first: int, last: int) -> float:
    """The mean of the values at ranks ``first`` and ``last``."""
    at, found = 0, []
    for v, n in values:
        found += [v for r in (first, last) if at <= r < at + n]
        at += n
    return (found[0] + found[1]) / 2 if first != last else found[0]


def _profiled(name: str, df: DataFrame, median: str, accuracy: int) -> list[tuple]:
    """Rows of one table's profile."""
    if median == "exact" and not read_from_files(df):
        df = materialize(df, "profiled")
    got = _figures(df, accuracy)
    numeric = [i for i, f in enumerate(df.schema.fields) if _is_numeric(f.dataType)]
    middle = {i: got[f"marks_{i}"][1] for i in numeric if got[f"n_{i}"]}
    if median == "exact" and middle:
        middle = _select(df, {i: (got[f"n_{i}"], got[f"marks_{i}"][0], got[f"marks_{i}"][2]) for i in middle})
    return [
        (name, f.name, i, got["rows"], got[f"nulls_{i}"], *(got.get(f"{k}_{i}") for k in ("min", "max", "mean")), middle.get(i))
        for i, f in enumerate(df.schema.fields)
    ]


def profiles(tables: Mapping[str, DataFrame], median: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """``table`` and ``PROFILE_COLUMNS``: the long-form profile of every table (the
    last four NULL for non-numeric columns)."""
    if median not in ("exact", "approx"):
        raise ValueError(f"median must be 'exact' or 'approx', not {median!r}")
    if not tables:
        raise ValueError("no table to profile")
    parts = concurrently(*[lambda t=t, df=df: _profiled(t, df, median, accuracy) for t, df in tables.items()])
    # One row per column of a profiled table: bounded by the schemas.
    schema = "table string, column string, ordinal int, row_count long, null_count long, min double, max double, mean double, median double"
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([r for part in parts for r in part], schema)


def profile(df: DataFrame, median: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """``PROFILE_COLUMNS`` of one table."""
    return profiles({"t": df}, median, accuracy).select(*PROFILE_COLUMNS)


def profile_json(df: DataFrame, median: str = "exact") -> DataFrame:
    """One row, one string column ``json``: ``row_count``, ``columns``,
    ``null_counts`` and ``numeric_columns`` {min, max, mean, median}; NULL
    figures are written as ``null``, not dropped."""
    return profile_docs({"t": df}, median).select("json")


def profile_docs(tables: Mapping[str, DataFrame], median: str = "exact") -> DataFrame:
    """One row per table: ``mart`` (its name) and ``json`` (its profile), from
    one ranking of all of them."""
    return _docs(tables, median).select("mart", F.to_json("profile", {"ignoreNullFields": "false"}).alias("json"))


def profiles_json(tables: Mapping[str, DataFrame], median: str = "exact") -> DataFrame:
    """One row, one string column ``json``: every table's profile keyed by name."""
    # One row per table: bounded by the number of tables exported.
    by_name = lambda a, b: F.when(a.mart < b.mart, -1).when(a.mart > b.mart, 1).otherwise(0)
    entries = F.array_sort(F.collect_list(F.struct("mart", "profile")), by_name)
    doc = _docs(tables, median).agg(F.map_from_entries(entries).alias("doc"))
    return doc.select(F.to_json("doc", {"ignoreNullFields": "false"}).alias("json"))


def _docs(tables: Mapping[str, DataFrame], median: str) -> DataFrame:
    """``mart`` and ``profile`` (a struct) of every table."""
    numeric = [f"{t}.{n}" for t, df in tables.items() for n in _numeric_names(df)]
    long = profiles(tables, median)
    is_num = F.concat("table", F.lit("."), "column").isin(*numeric) if numeric else F.lit(False)
    stats = F.struct("min", "max", "mean", "median")
    rows = long.select("table", "row_count", F.struct("ordinal", "column", "null_count", is_num.alias("is_num"), stats.alias("stats")).alias("e"))
    # One row per column of a profiled table: bounded by the schemas.
    agg = rows.groupBy("table").agg(F.max("row_count").alias("row_count"), F.array_sort(F.collect_list("e")).alias("es"))
    names = F.transform("es", lambda e: e["column"])
    figures = F.transform(F.filter("es", lambda e: e["is_num"]), lambda e: F.struct(e["column"].alias("k"), e["stats"].alias("v")))
    return agg.select(
        F.col("table").alias("mart"),
        F.struct(
            "row_count", names.alias("columns"),
            F.map_from_arrays(names, F.transform("es", lambda e: e["null_count"])).alias("null_counts"),
            F.map_from_entries(figures).alias("numeric_columns"),
        ).alias("profile"),
    )


def _numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if _is_numeric(f.dataType)]
