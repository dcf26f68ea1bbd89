"""Properties over the adapter's trips and randomised inputs."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.operators import facts as FT
from starmart.operators import marts as M
from starmart.operators.keys import dense_key
from starmart.sources.adapter import trips_from_tables
from starmart.sources.staging import stage

from star_data import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_ids_do_not_depend_on_shuffle_partitions(spark):
    trips = stage(trips_from_tables(spark, SF_SMALL))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = FT.build_star(trips, stage_input=False).fact
        # and without adaptive execution (no coalescing, no runtime re-plans)
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        b = FT.build_star(trips, stage_input=False).fact
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert _same(a, b)
    assert a.agg(F.min("trip_id"), F.max("trip_id"), F.count("*")).first() == (1, 5082, 5082)


def test_grain_fact_counts(spark):
    trips = stage(trips_from_tables(spark, SF_SMALL))
    keyed = trips.where("passenger_count IS NOT NULL")
    # distinct grain: one fact per trip with no NULL key
    assert FT.build_star(trips, stage_input=False).fact.count() == keyed.count()
    # per-row grain: each kept trip meets every trip of its timestamp pair
    pair_sizes = trips.groupBy("pickup_datetime", "dropoff_datetime").agg(F.count("*").alias("n"))
    expected = keyed.join(pair_sizes, ["pickup_datetime", "dropoff_datetime"]).agg(F.sum("n")).first()[0]
    assert FT.build_star(trips, grain="per_row", stage_input=False).fact.count() == expected == 7896


def test_percentages_add_up(spark):
    trips = stage(trips_from_tables(spark, SF_SMALL))
    s = FT.build_star(trips, stage_input=False)
    total = M.payment_distribution(s.fact, s.payment).agg(F.sum("percentage")).first()[0]
    assert abs(total - 100.0) <= 0.01 * 5


def test_fact_through_sort_merge_and_skew_split(spark, monkeypatch):
    """With broadcasts off and a hot timestamp pair, the big join is a
    sort-merge join that AQE splits; the fact is unchanged."""

    hot = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 08:00:00")).otherwise(
            F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).cast("string")
        ).cast("timestamp_ntz").alias("pickup_datetime"),
    )
    trips = hot.select(
        "pickup_datetime",
        F.timestamp_add("SECOND", F.lit(600), "pickup_datetime").alias("dropoff_datetime"),
        F.lit(40.5).alias("pickup_latitude"), F.lit(-74.0).alias("pickup_longitude"),
        F.lit(40.75).alias("dropoff_latitude"), F.lit(-73.5).alias("dropoff_longitude"),
        F.lit(1).alias("passenger_count"), F.lit(1.0).alias("trip_distance"), F.lit(5.0).alias("fare_amount"),
        F.lit(1.0).alias("tip_amount"), F.lit(6.0).alias("total_amount"), F.lit(1).cast("long").alias("payment_type"),
    )
    trips = stage(trips)
    base = FT.build_star(trips, stage_input=False)
    expected = base.fact
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = FT.build(trips, base.datetime, base.location, base.payment, base.passenger)
        assert _same(fact, expected)
        assert fact.count() == 6000
        hourly = M.hourly(fact, base.datetime)
        hourly.collect()
        assert "SortMergeJoin" in hourly._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=0, max_size=60), st.integers(1, 9))
def test_dense_key_matches_brute_force(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    keyed = dense_key(df, ["v"], name="k", unique=False, num_partitions=parts).collect()
    got = sorted((r.k, r.v) for r in keyed)
    ordered = sorted(values, key=lambda v: (v is not None, v if v is not None else 0))
    assert [k for k, _ in got] == list(range(1, len(values) + 1))
    assert [v for _, v in got] == ordered


def test_unordered_trip_ids_are_dense_and_facts_equal(spark):
    trips = stage(trips_from_tables(spark, SF_SMALL))
    a = FT.build_star(trips, stage_input=False)
    b = FT.build_star(trips, stage_input=False, order_ids=False)
    assert b.fact.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")).first() == (1, 5082, 5082)
    assert _same(a.fact.drop("trip_id"), b.fact.drop("trip_id"))


def test_weights_give_the_per_row_marts_without_pairs(spark):
    trips = stage(trips_from_tables(spark, SF_SMALL))
    few = FT.build_star(trips, stage_input=False)
    many = FT.build_star(trips, grain="per_row", stage_input=False)
    fact = FT.weigh(few.fact, few.datetime, trips)
    assert fact.agg(F.sum("weight")).first()[0] == many.fact.count()
    for make, dim in ((M.hourly, "datetime"), (M.daily, "datetime"), (M.payment, "payment"), (M.popular_locations, "location"),
                      (M.payment_distribution, "payment")):
        assert _same(make(fact, getattr(few, dim)), make(many.fact, getattr(many, dim)))
    assert _same(M.summary(fact), M.summary(many.fact))
    plan = M.hourly(fact, few.datetime)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan


def test_pairs_that_are_dropped_do_not_stop_the_per_row_build(spark):
    """Many trips without times: they have no fact, and k * k of the others do."""
    trips = trips_from_tables(spark, SF_SMALL).where("passenger_count is not null").limit(2)
    one = trips.limit(1)
    good = one.unionAll(one)
    bad = one.withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz")).crossJoin(spark.range(30)).drop("id")
    assert FT.build_star(good.unionAll(bad), grain="per_row").fact.count() == 4


def test_scratch_scopes_of_two_threads_are_apart(spark):
    import threading

    from starmart.checkpoint import app_root, materialize, scratch_scope

    inside, release, seen = threading.Event(), threading.Event(), {}

    def other():
        with scratch_scope(spark):
            seen["other"] = app_root(spark)
            inside.set()
            release.wait(60)

    t = threading.Thread(target=other)
    t.start()
    assert inside.wait(60)
    with scratch_scope(spark) as folder:
        kept = materialize(spark.range(5), "mine")
        assert app_root(spark) == folder != seen["other"]
        release.set()
        t.join()
        assert app_root(spark) == folder and kept.count() == 5
