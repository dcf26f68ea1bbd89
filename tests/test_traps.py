"""Traps found while reading the source system and input edge cases."""

from __future__ import annotations

import math
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starmart.operators.profile import profile
from starmart.sources.trips import normalize, read_trips_csv, read_trips_parquet


def test_csv_codes_written_as_decimals_are_read_as_codes(spark, hand):
    # T5: a code column written as "1.0" must not break the payment join.
    d = tempfile.mkdtemp(prefix="starmart-test-")
    hand.withColumn("payment_type", F.col("payment_type").cast("double")).withColumn(
        "passenger_count", F.col("passenger_count").cast("double")
    ).write.option("header", True).csv(f"{d}/t")
    back = read_trips_csv(spark, f"{d}/t")
    assert sorted(r.payment_type for r in back.collect() if r.payment_type is not None) == [1, 1, 2, 3, 9]
    assert dict(back.dtypes)["payment_type"] == "bigint"


def test_profile_treats_nan_as_null(spark):
    # T8: NaN is a NULL for the profile; min/max/mean/median skip it.
    df = spark.createDataFrame([(1.0, True, "a"), (float("nan"), False, None), (3.0, None, "b"), (None, True, "c")],
                               "x double, flag boolean, s string")
    rows = {r["column"]: r for r in profile(df).collect()}
    x = rows["x"]
    assert (x.row_count, x.null_count, x["min"], x["max"], x.mean, x.median) == (4, 2, 1.0, 3.0, 2.0, 2.0)
    # booleans and strings are not numeric
    assert rows["flag"]["min"] is None and rows["s"]["median"] is None
    assert rows["flag"].null_count == 1 and rows["s"].null_count == 1
    approx = {r["column"]: r for r in profile(df, median="approx").collect()}
    assert approx["x"].median in (1.0, 3.0)


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "x double, n int")
    rows = {r["column"]: r for r in profile(df).collect()}
    assert rows["x"].row_count == 0 and rows["x"]["min"] is None and rows["n"].median is None


def test_exact_median_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 4, 2]], "v int")
    (r,) = profile(df).collect()
    assert r.median == 3.0 and math.isclose(r.mean, 3.0)


def test_malformed_timestamp_raises(spark):
    # P4: parsing is strict (ANSI); a bad value is an error, not a NULL.
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "not a time", 1.0, 1.0, 1, 2, 1.0, 1.0, 0.0, 1.0)],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double, trip_distance double, "
        "PULocationID long, DOLocationID long, payment_type double, fare_amount double, tip_amount double, "
        "total_amount double",
    )
    with pytest.raises(Exception) as e:
        normalize(df).collect()
    assert "CAST" in str(e.value).upper() or "PARSE" in str(e.value).upper()


def test_missing_parquet_path_raises_before_work(spark):
    # S3
    with pytest.raises(AnalysisException):
        read_trips_parquet(spark, ["/nonexistent/jan.parquet", "/nonexistent/feb.parquet"])


def test_nan_codes_become_null_members(spark):
    # A4: NaN in a float code column is a member; it maps to the NULL code.
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:10:00", float("nan"), 1.0, 1, 2, float("nan"), 1.0, 0.0, 1.0)],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double, trip_distance double, "
        "PULocationID long, DOLocationID long, payment_type double, fare_amount double, tip_amount double, "
        "total_amount double",
    )
    (r,) = normalize(df).collect()
    assert r.passenger_count is None and r.payment_type is None


def test_exact_median_matches_pandas(spark):
    import starmart.operators.profile as P

    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 1000).cast("double").alias("x"), (F.col("id") % 7).alias("k"),
                                     F.when(F.col("id") % 3 == 0, F.col("id")).alias("gaps"), F.lit("t").alias("text"))
    got = {r["column"]: r for r in P.profile(df).collect()}
    pdf = df.toPandas()  # small, test only
    for c in ("x", "k", "gaps"):
        assert got[c]["median"] == float(pdf[c].median()) and got[c]["null_count"] == int(pdf[c].isna().sum())
    assert got["text"]["median"] is None and got["text"]["row_count"] == 2000
    both = P.profiles({"a": df, "b": df.where("false")}).collect()
    assert {(r["table"], r["row_count"]) for r in both} == {("a", 2000), ("b", 0)} and len(both) == 8


def test_fractional_codes_are_an_error(spark, hand):
    from starmart.sources.trips import normalize, read_trips_csv
    from starmart.schema import TRIPS_COORD

    d = tempfile.mkdtemp(prefix="starmart-test-")
    big = hand.withColumn("payment_type", F.lit(9007199254740993))
    big.write.option("header", True).csv(f"{d}/big")
    assert {r.payment_type for r in read_trips_csv(spark, f"{d}/big").collect()} == {9007199254740993}
    bad = hand.withColumn("payment_type", F.lit("2.5"))
    bad.write.option("header", True).csv(f"{d}/bad")
    for df in (lambda: read_trips_csv(spark, f"{d}/bad"), lambda: normalize(hand.withColumn("passenger_count", F.lit(1.7)), {}, TRIPS_COORD)):
        with pytest.raises(Exception, match="whole number"):
            df().collect()


def test_csv_malformed_value_fails_the_read(spark, hand):
    # P4 for the CSV lane: no silent NULLs from unparsable values.
    from starmart.sources.trips import read_trips_csv

    d = tempfile.mkdtemp(prefix="starmart-test-")
    bad = hand.withColumn("pickup_datetime", F.when(F.col("fare_amount") == 10, F.lit("not a time"))
                          .otherwise(F.col("pickup_datetime").cast("string")))
    bad.write.option("header", True).csv(f"{d}/t")
    with pytest.raises(Exception) as e:
        read_trips_csv(spark, f"{d}/t").collect()
    assert "MALFORMED" in str(e.value).upper() or "FAILFAST" in str(e.value).upper() or "PARSE" in str(e.value).upper()
