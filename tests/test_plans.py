"""Plan shape: broadcasts where sizes are checked, pruning at the scan,
partial aggregation before the shuffle."""

from __future__ import annotations

from starmart.operators import facts as FT
from starmart.operators import marts as M
from starmart.operators.joins import lookup_join
from starmart.plans.queries import star, _trips

from star_data import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_broadcasts_small_dimensions(spark):
    s = star(spark, SF_SMALL)
    trips = _trips(spark, SF_SMALL)
    pay = s.payment.select("payment_id", s.payment.payment_type.cast("long").alias("_k"))
    joined = lookup_join(trips, pay, [("payment_type", "_k")])
    assert "BroadcastHashJoin" in _plan(joined)


def test_mart_plan_prunes_columns_and_aggregates_partially(spark):
    s = star(spark, SF_SMALL)
    mart = M.payment(s.fact, s.payment)
    mart.collect()
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "partial_avg" in plan or "partial_count" in plan
    # The fact scan reads only what the mart needs.
    scan_schemas = [ln for ln in mart._jdf.queryExecution().toString().splitlines() if "ReadSchema" in ln]
    assert scan_schemas
    for ln in scan_schemas:
        assert "pickup_datetime" not in ln


def test_a_dimension_beyond_the_threshold_is_not_broadcast(spark):
    s = star(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "1k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1k"}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        mart = M.hourly(s.fact, s.datetime)
        mart.collect()
        assert "SortMergeJoin" in _plan(mart) and "BroadcastHashJoin" not in _plan(mart)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_defining_marts_runs_no_job(spark):
    s = star(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("marts-only", "no job expected")
    try:
        M.marts(s)
        M.summary_report(s.fact, s.payment)
        assert list(tracker.getJobIdsForGroup("marts-only")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def test_publish_skips_what_fails_and_writes_the_rest(spark, hand, tmp_path):
    import os
    from dataclasses import replace

    from starmart.plans import publish

    s = FT.build_star(hand)
    broken = replace(s, fact=s.fact.drop("tip_amount"))
    status = publish(broken, str(tmp_path / "skip"), on_error="skip")
    assert {k for k, v in status.items() if v == "ok"} == {"vw_popular_locations", "vw_daily_stats"}
    assert status["vw_hourly_fares"].startswith("error") and status["vw_payment_analysis"].startswith("error")
    assert {"mart=vw_daily_stats", "mart=vw_popular_locations"} <= set(os.listdir(tmp_path / "skip" / "profiles"))
    assert os.path.exists(tmp_path / "skip" / "summary_report.json")
    try:
        publish(broken, str(tmp_path / "raise"))
    except Exception as e:  # noqa: BLE001
        assert "tip_amount" in str(e)
    else:
        raise AssertionError("publish must raise")


def test_build_appends_with_the_declared_schemas(spark, hand, tmp_path):
    from starmart.plans import build
    from starmart.schema import STAR_SCHEMAS

    out = str(tmp_path / "star")
    n = build(hand, out).fact.count()
    star2 = build(hand, out, mode="append", first_id=1000, check=False)
    assert star2.fact.count() == 2 * n
    for name, df in star2.tables().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in STAR_SCHEMAS["coords"][name]]


def test_pipeline_run_end_to_end(spark, hand, tmp_path):
    import json
    import os

    from starmart.plans import run

    src = str(tmp_path / "raw")
    hand.write.option("header", True).csv(src)
    out = str(tmp_path / "out")
    status = run(spark, src, out)
    assert status == {k: "ok" for k in ["vw_hourly_fares", "vw_popular_locations", "vw_payment_analysis", "vw_daily_stats"]}
    processed = f"{out}/processed"
    names = set(os.listdir(processed))
    assert {"vw_hourly_fares.csv", "profiles", "summary_report.json"} <= names
    prof_dir = f"{processed}/profiles/mart=vw_daily_stats"
    prof = json.loads("".join(open(os.path.join(prof_dir, f)).read() for f in os.listdir(prof_dir) if f.startswith("part-")))
    assert prof["row_count"] == 2 and prof["columns"][:3] == ["pickup_year", "pickup_month", "pickup_day"]
    assert sorted(d for d in os.listdir(f"{processed}/profiles") if d.startswith("mart=")) == sorted(
        ["mart=vw_daily_stats", "mart=vw_hourly_fares", "mart=vw_payment_analysis", "mart=vw_popular_locations"])
    rep_dir = f"{processed}/summary_report.json"
    txt = "".join(open(os.path.join(rep_dir, f)).read() for f in os.listdir(rep_dir) if f.startswith("part-"))
    assert json.loads(txt)["overall_stats"]["total_trips"] == 4
    # star tables were written and can be read back
    assert spark.read.parquet(f"{out}/star/fact_trips").count() == 4


def test_zone_star_build_writes_and_checks(spark, hand, tmp_path):
    from pyspark.sql import functions as F

    from starmart.plans import build

    zones = hand.select(
        "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        F.lit(1).cast("long").alias("pickup_location_id"), F.lit(2).cast("long").alias("dropoff_location_id"),
        "payment_type", "fare_amount", "tip_amount", "total_amount",
    )
    z = build(zones, str(tmp_path / "z"), variant="zones")
    assert isinstance(z, FT.Star) and z.fact.count() == 6


def test_extract_counts_during_the_staging_write(spark, hand, tmp_path):
    from starmart.plans import extract

    src = str(tmp_path / "raw")
    hand.write.option("header", True).csv(src)
    ex = extract(spark, src)
    assert ex.row_count == 6 and ex.trips.count() == 6
    named = str(tmp_path / "staging")
    assert extract(spark, src, staging_path=named).row_count == 6
    # create-if-absent keeps the existing table
    again = extract(spark, src, staging_path=named, mode="ignore")
    assert again.row_count == 6


def test_extract_parquet_months(spark, hand, tmp_path):
    from pyspark.sql import functions as F

    from starmart.plans import extract

    src = hand.select(
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        "passenger_count", "trip_distance",
        F.lit(1).cast("long").alias("PULocationID"), F.lit(2).cast("long").alias("DOLocationID"),
        "payment_type", "fare_amount", "tip_amount", "total_amount",
    )
    src.write.parquet(str(tmp_path / "jan"))
    src.write.parquet(str(tmp_path / "feb"))
    ex = extract(spark, [str(tmp_path / "jan"), str(tmp_path / "feb")], source="parquet")
    assert ex.row_count == 12 and ex.trips.columns[4] == "pickup_location_id"


def test_zone_lane_run_publishes_combined_profile(spark, hand, tmp_path):
    import json
    import os

    from pyspark.sql import functions as F

    from starmart.plans import run

    src = hand.select(
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        "passenger_count", "trip_distance",
        F.lit(1).cast("long").alias("PULocationID"), F.lit(2).cast("long").alias("DOLocationID"),
        "payment_type", "fare_amount", "tip_amount", "total_amount",
    )
    src.write.parquet(str(tmp_path / "jan"))
    out = str(tmp_path / "out")
    status = run(spark, [str(tmp_path / "jan")], out, source="parquet")
    assert status["vw_hourly_fares"] == "ok" and status["vw_daily_stats"] == "ok"
    assert status["vw_popular_locations"].startswith("skipped")
    d = f"{out}/processed/analytics_stats.json"
    doc = json.loads("".join(open(os.path.join(d, f)).read() for f in os.listdir(d) if f.startswith("part-")))
    assert set(doc) == {"vw_hourly_fares", "vw_payment_analysis", "vw_daily_stats"}
    assert doc["vw_hourly_fares"]["row_count"] == 4  # hours 0, 6, 12, 23 (the zone lane keeps every trip)


def test_run_releases_only_its_own_intermediates(spark, hand, tmp_path):
    from starmart.checkpoint import app_root, materialize
    from starmart.plans import run

    keep = materialize(hand, "keep")  # made outside the run: must survive it
    src = str(tmp_path / "raw")
    hand.write.option("header", True).csv(src)
    run(spark, src, str(tmp_path / "out"))
    assert keep.count() == 6
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(app_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not [s for s in fs.listStatus(path) if s.getPath().getName().startswith("run-")]


def test_bucketed_star_joins_without_shuffle(spark, hand, tmp_path):
    from starmart.operators import quality as Q
    from starmart.plans import build

    star = build(hand, str(tmp_path / "star"), buckets=4, table_prefix="t_bucketed_")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        mart = M.hourly(star.fact, star.datetime)
        assert sorted(tuple(r) for r in mart.collect()) == [(0, 15.0, 2, 1.0, 16.0), (6, 16.0, 1, 4.0, 20.0),
                                                             (23, 0.0, 1, 0.0, 0.0)]
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        # the only exchange is the (partial) aggregate's, by pickup_hour
        assert "hashpartitioning(datetime_id" not in plan and "hashpartitioning(_k_id" not in plan
        orphans = Q.check_orphans(star.fact, star.tables(), {"datetime_id": "dim_datetime"})
        assert [r.failures for r in orphans.collect()] == [0]
        assert "hashpartitioning(datetime_id" not in orphans._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_command_line_steps(spark, hand, tmp_path):
    from starmart.__main__ import main

    src = str(tmp_path / "raw")
    hand.write.option("header", True).csv(src)
    staging, star_dir, out = str(tmp_path / "staging"), str(tmp_path / "star"), str(tmp_path / "processed")
    assert main(["extract", "--input", src, "--staging", staging], spark) == {"staging": staging, "rows": 6}
    main(["build", "--input", staging, "--source", "staged", "--star", star_dir], spark)
    status = main(["publish", "--star", star_dir, "--out", out], spark)
    assert set(status.values()) == {"ok"}
    assert spark.read.option("header", True).csv(f"{out}/vw_daily_stats.csv").count() == 2


def test_summary_report_scans_the_fact_once(spark):
    s = star(spark, SF_SMALL)
    report = M.summary_report(s.fact, s.payment)
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    fact_scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and "total_amount" in ln]
    assert len(fact_scans) == 1
    assert "Subquery" not in final


def test_published_marts_read_the_fact_once(spark):
    s = star(spark, SF_SMALL)
    plan = _plan(M.grand_rollup(s))
    # One scan for the fact, one for each dimension that is grouped by.
    assert plan.count("FileScan") == 4 and plan.count("Expand") == 1
    split = M.split_grand_rollup(M.grand_rollup(s))
    for name, one in (("hourly", M.hourly(s.fact, s.datetime)), ("popular_locations", M.popular_locations(s.fact, s.location)),
                      ("payment", M.payment(s.fact, s.payment)), ("daily", M.daily(s.fact, s.datetime))):
        assert split[name].columns == one.columns
        assert split[name].exceptAll(one).count() == 0 and one.exceptAll(split[name]).count() == 0
    report, whole = M.rollup_report(M.grand_rollup(s)).first(), M.summary_report(s.fact, s.payment).first()
    assert report == whole


def test_a_fact_that_one_dimension_lacks_counts_in_the_others(spark):
    s = star(spark, SF_SMALL)
    lame = FT.Star(s.datetime, s.location, s.payment.where("payment_id > 1"), s.passenger, s.fact)
    split = M.split_grand_rollup(M.grand_rollup(lame))
    one = M.payment(lame.fact, lame.payment)
    assert split["payment"].exceptAll(one).count() == 0 and one.count() == split["payment"].count()
    assert split["hourly"].agg({"num_trips": "sum"}).first()[0] == s.fact.count()
    assert M.rollup_report(M.grand_rollup(lame)).first() == M.summary_report(lame.fact, lame.payment).first()
