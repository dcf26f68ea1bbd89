"""Readers, normalisation, union by name, writers and round trips."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starmart.operators import facts as FT
from starmart.operators import marts as M
from starmart.operators.profile import profile_json, profiles_json
from starmart.schema import TRIPS_COORD, TRIPS_ZONE
from starmart.sinks import export_all, export_csv, export_json, save, save_table_with_schema
from starmart.sources.trips import (
    MissingColumnsError,
    normalize,
    read_trips_csv,
    read_trips_parquet,
    union_months,
)


def _scratch():
    return tempfile.mkdtemp(prefix="starmart-test-")


def test_csv_round_trip_with_declared_schema(spark, hand):
    d = _scratch()
    hand.write.option("header", True).csv(f"{d}/trips")
    back = read_trips_csv(spark, f"{d}/trips")
    assert back.schema == TRIPS_COORD
    assert back.exceptAll(hand).count() == 0 and hand.exceptAll(back).count() == 0


def test_csv_missing_column_and_missing_path(spark, hand):
    d = _scratch()
    hand.drop("tip_amount").write.option("header", True).csv(f"{d}/trips")
    with pytest.raises(MissingColumnsError):
        read_trips_csv(spark, f"{d}/trips")
    with pytest.raises(AnalysisException):
        read_trips_csv(spark, f"{d}/does-not-exist")


def test_parquet_months_rename_and_union_by_name(spark, hand):
    d = _scratch()
    src = hand.select(
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        F.col("passenger_count").cast("double").alias("passenger_count"),
        "trip_distance",
        F.lit(1).cast("long").alias("PULocationID"),
        F.lit(2).cast("long").alias("DOLocationID"),
        F.col("payment_type").cast("double").alias("payment_type"),
        "fare_amount", "tip_amount", "total_amount",
    )
    src.limit(3).withColumn("airport_fee", F.lit(1.25)).write.parquet(f"{d}/jan")
    src.subtract(src.limit(3)).write.parquet(f"{d}/feb")
    raw = read_trips_parquet(spark, [f"{d}/jan", f"{d}/feb"])
    assert raw.count() == 6
    assert raw.where(F.col("airport_fee").isNull()).count() == 3
    trips = normalize(raw)
    assert trips.schema == TRIPS_ZONE


def test_union_keeps_duplicates_and_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(1,)], "k int")
    u = union_months([a, b, b])
    rows = [tuple(r) for r in u.collect()]
    assert sorted(rows, key=repr) == sorted([(1, None), (1, None), (1, "x")], key=repr)


def test_normalize_rejects_missing(spark):
    df = spark.createDataFrame([(1,)], "tpep_pickup_datetime int")
    with pytest.raises(MissingColumnsError):
        normalize(df)


def test_save_modes_and_declared_schema(spark, hand):
    d = _scratch()
    save(hand, f"{d}/t")
    save(hand, f"{d}/t")  # overwrite: idempotent
    assert spark.read.parquet(f"{d}/t").count() == 6
    save(hand, f"{d}/t", mode="append")
    assert spark.read.parquet(f"{d}/t").count() == 12
    save(hand.limit(1), f"{d}/t", mode="ignore")
    assert spark.read.parquet(f"{d}/t").count() == 12
    fact = spark.createDataFrame([(1.0, 2.5)], "trip_id double, trip_duration double")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("trip_id", T.LongType()), T.StructField("trip_duration", T.IntegerType())])
    save_table_with_schema(fact, f"{d}/f", schema)
    assert tuple(spark.read.parquet(f"{d}/f").first()) == (1, 2)  # 2.5 rounds half-even


def test_csv_export_sorted_and_read_back(spark, hand):
    d = _scratch()
    star = FT.build_star(hand)
    mart = M.hourly(star.fact, star.datetime)
    export_csv(mart, f"{d}/hourly", M.mart_order("hourly"), single_file=True)
    files = [f for f in os.listdir(f"{d}/hourly") if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(f"{d}/hourly/{files[0]}").read().splitlines()
    assert lines[0] == "pickup_hour,avg_fare,num_trips,avg_tip,avg_total"
    assert [ln.split(",")[0] for ln in lines[1:]] == ["0", "6", "23"]


def test_json_exports_keep_nulls(spark, hand):
    d = _scratch()
    star = FT.build_star(hand)
    empty = star.fact.where("false")
    export_json(M.summary(empty), f"{d}/summary")
    txt = "".join(open(os.path.join(f"{d}/summary", f)).read() for f in os.listdir(f"{d}/summary") if f.endswith(".json"))
    assert json.loads(txt) == {"total_trips": 0, "total_revenue": None, "avg_distance": None, "avg_duration_minutes": None}
    report = M.summary_report(star.fact, star.payment)
    export_json(report, f"{d}/report")
    txt = "".join(open(os.path.join(f"{d}/report", f)).read() for f in os.listdir(f"{d}/report") if f.endswith(".json"))
    doc = json.loads(txt)
    assert doc["overall_stats"]["total_trips"] == 4
    assert [r["payment_name"] for r in doc["payment_distribution"]] == ["Cash", "Credit Card", "No Charge", "Unknown"]


def test_profile_json_shapes(spark, hand):
    star = FT.build_star(hand)
    mart = M.payment(star.fact, star.payment)
    doc = json.loads(profile_json(mart).first()[0])
    assert doc["row_count"] == 4
    assert doc["columns"] == mart.columns
    assert doc["null_counts"] == {c: 0 for c in mart.columns}
    assert list(doc["numeric_columns"]) == mart.columns[1:]
    assert doc["numeric_columns"]["num_trips"] == {"min": 1.0, "max": 1.0, "mean": 1.0, "median": 1.0}
    both = json.loads(profiles_json({"a": mart, "b": M.hourly(star.fact, star.datetime)}).first()[0])
    assert list(both) == ["a", "b"] and both["b"]["row_count"] == 3


def test_export_all_policies(spark, hand):
    d = _scratch()
    star = FT.build_star(hand)

    def broken():
        return star.fact.select("no_such_column")

    marts = {"hourly": M.hourly(star.fact, star.datetime), "bad": broken, "daily": M.daily(star.fact, star.datetime)}
    status = export_all(marts, d, on_error="skip")
    assert status["hourly"] == "ok" and status["daily"] == "ok" and status["bad"].startswith("error")
    with pytest.raises(AnalysisException):
        export_all(marts, _scratch(), on_error="raise")


def test_stage_deals_out_only_when_told(spark, hand):
    from starmart.sources.staging import stage

    d = _scratch()
    hand.coalesce(1).write.parquet(f"{d}/one")
    one = spark.read.parquet(f"{d}/one")
    assert len(stage(one).inputFiles()) == 1
    assert len(stage(one, partitions=3).inputFiles()) == 3
