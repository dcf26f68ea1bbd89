"""Every check fails on one broken row and passes on the clean star."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart.operators import facts as FT
from starmart.operators import quality as Q
from starmart.plans.pipeline import checks
from starmart.schema import TRIPS_COORD
from starmart.sources.trips import MissingColumnsError, require_columns


def _failures(df):
    return {(r["check"], r["column"]): r["failures"] for r in df.collect()}


def test_required_columns_reports_missing_in_order(hand):
    cols = [c for c in hand.columns if c != "tip_amount"]
    with pytest.raises(MissingColumnsError) as e:
        require_columns(cols, TRIPS_COORD.fieldNames())
    assert e.value.missing == ["tip_amount"]
    require_columns(hand.columns, TRIPS_COORD.fieldNames())


def test_not_null_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (None, float("nan")), (3, None)], "a int, b double")
    assert _failures(Q.check_not_null(df, ["a", "b"])) == {("not_null", "a"): 1, ("not_null", "b"): 2}


def test_non_negative(spark, hand):
    broken = hand.withColumn("trip_distance", F.when(F.col("fare_amount") == 10, -1.0).otherwise(F.col("trip_distance")))
    f = _failures(Q.check_non_negative(broken, ["trip_distance", "fare_amount"]))
    assert f == {("non_negative", "trip_distance"): 1, ("non_negative", "fare_amount"): 0}
    nan = spark.createDataFrame([(float("nan"),), (None,), (0.0,)], "x double")
    assert _failures(Q.check_non_negative(nan, ["x"])) == {("non_negative", "x"): 0}


def test_unique_and_not_null_key(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,)], "k long")
    assert _failures(Q.check_unique(df, "k", "t")) == {("unique", "t.k"): 2, ("not_null", "t.k"): 1}


def test_orphans(hand):
    star = FT.build_star(hand)
    clean = _failures(Q.check_orphans(star.fact, star.tables()))
    assert set(clean.values()) == {0} and len(clean) == 4
    broken = star.fact.withColumn("location_id", F.when(F.col("fare_amount") == 10, 999).otherwise(F.col("location_id")))
    f = _failures(Q.check_orphans(broken, star.tables()))
    assert f[("orphans", "location_id->dim_location")] == 1
    assert f[("orphans", "datetime_id->dim_datetime")] == 0


def test_run_checks_raises_and_lists_failures(hand):
    star = FT.build_star(hand)
    assert all(n == 0 for _, _, n in Q.run_checks(checks(star)))
    bad = star.fact.withColumn("passenger_id", F.lit(None).cast("long"))
    with pytest.raises(Q.CheckFailed) as e:
        Q.run_checks(Q.check_not_null(bad, ["trip_id", "passenger_id"]))
    assert e.value.failures == [("not_null", "passenger_id", 4)]
    assert Q.run_checks(Q.check_not_null(bad, ["passenger_id"]), raise_on_failure=False) == [
        ("not_null", "passenger_id", 4)]


def test_zone_checks_pass_on_zone_star(hand):
    zones = hand.select(
        "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        F.lit(1).cast("long").alias("pickup_location_id"), F.lit(2).cast("long").alias("dropoff_location_id"),
        "payment_type", "fare_amount", "tip_amount", "total_amount",
    )
    z = FT.build_zone_star(zones)
    assert all(n == 0 for _, _, n in Q.run_checks(checks(z)))
