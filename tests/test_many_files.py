"""A long series of monthly files: a handful of scans, types resolved by rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart.sources.trips import normalize, parquet_schemas, read_trips_parquet


def _months(spark, tmp_path, kinds):
    paths = []
    for k, kind in enumerate(kinds):
        path = f"{tmp_path}/m{k:03d}"
        df = spark.range(k, k + 1, 1, 1).select(F.col("id").cast(kind).alias("passenger_count"), F.col("id").alias("n"))
        (df.withColumn("airport_fee", F.lit(1.0)) if k % 4 == 0 else df).write.parquet(path)
        paths.append(path)
    return paths


def test_many_files_of_drifting_types(spark, tmp_path):
    kinds = ["long"] * 20 + ["double"] * 15 + ["int"] + ["long"] * 12 + ["double"] * 2
    paths = _months(spark, tmp_path, kinds)
    groups = parquet_schemas(spark, paths)
    assert sorted(len(p) for _, p in groups) == [1, 17, 32]
    assert sorted(x for _, p in groups for x in p) == sorted(paths)
    df = read_trips_parquet(spark, paths)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 3
    got = sorted((r["n"], r["passenger_count"], r["airport_fee"]) for r in df.select("n", "passenger_count", F.coalesce("airport_fee", F.lit(0.0)).alias("airport_fee")).collect())
    assert got == [(k, float(k), 1.0 if k % 4 == 0 else 0.0) for k in range(len(kinds))]


def test_equal_types_are_one_scan(spark, tmp_path):
    paths = _months(spark, tmp_path, ["long"] * 12)
    df = read_trips_parquet(spark, paths)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and df.count() == 12
    assert read_trips_parquet(spark, paths[3]).columns == ["passenger_count", "n"]


def test_codes_of_either_type_become_whole_numbers(spark, tmp_path):
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField("passenger_count", T.IntegerType()), T.StructField("n", T.LongType())])
    out = normalize(read_trips_parquet(spark, _months(spark, tmp_path, ["long", "double", "int"])), {}, schema)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schema.fields]
    assert sorted(map(tuple, out.collect())) == [(0, 0), (1, 1), (2, 2)]


def test_errors_are_kept(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_trips_parquet(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError):
        read_trips_parquet(spark, [])
