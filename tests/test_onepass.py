"""Both ids from one range pass: equal to the two-step build, however cut."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from star_data import SF_SMALL

from starmart.operators import dims as D
from starmart.operators import facts as FT
from starmart.operators import onepass as O
from starmart.operators import quality as Q
from starmart.plans.queries import _trips
from starmart.schema import TRIPS_COORD
from starmart.sources.staging import stage


def _random_trips(spark, n=400, seed=3, hot=0.4):
    draw = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        same = draw.random() < hot
        pick = day if same else draw.choice([None, day + dt.timedelta(minutes=draw.randrange(60))])
        drop = day + dt.timedelta(minutes=5) if same else draw.choice([None, day + dt.timedelta(minutes=draw.randrange(5))])
        lat = draw.choice([40.5, 40.75, None])
        rows.append((pick, drop, lat, -74.0, 40.5, -73.5, draw.choice([1, 2, None]), float(draw.randrange(3)), 1.0, 0.5, 1.5, draw.choice([1, 2, 9, None])))
    return stage(spark.createDataFrame(rows, TRIPS_COORD).repartition(4))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("null_keys", ["drop", "match"])
def test_equals_the_two_step_build(spark, null_keys):
    trips = _random_trips(spark)
    loc, pay, pas = D.location_dim(trips), D.payment_dim(trips), D.passenger_dim(trips)
    pairs, fact = FT.build_both(trips, loc, pay, pas, null_keys)
    dims = D.datetime_dim(trips)
    assert _same(pairs, dims)
    assert _same(fact, FT.build(trips, dims, loc, pay, pas, null_keys))


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_groups_go_on_over_partitions(spark, parts):
    """A third of the rows are of one group, and all alike."""
    rows = [(i % 7, None if i % 5 == 0 else "a", i % 3 > 0) for i in range(200)] + [(3, "b", i % 2 == 0) for i in range(100)]
    df = O.with_sequence(spark.createDataFrame(rows, "g int, v string, c boolean").repartition(5), ["g", "v", "c"])
    found, groups = O.number_both(df, ["g"], ["g", "v", "c"], "c", ["g", "v"], "gid", "id", 10, parts)
    assert sorted(map(tuple, groups.collect())) == [(10 + g, g) for g in range(7)]
    got = sorted(map(tuple, found.collect()))
    assert [r[0] for r in got] == list(range(10, 10 + sum(r[2] for r in rows)))
    assert all(r[1] == 10 + r[2] for r in got)
    assert [(r[2], r[3] or "") for r in got] == sorted((g, v or "") for g, v, c in rows if c)
    if parts == 40:
        per = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(per) > 1


def test_empty(spark):
    df = O.with_sequence(spark.createDataFrame([], "g int, c boolean"), ["g"])
    found, groups = O.number_both(df, ["g"], ["g"], "c", ["g"], "gid", "id")
    assert found.columns == ["id", "gid", "g"] and found.count() == groups.count() == 0


def test_no_join_with_the_datetime_dimension(spark):
    trips = _trips(spark, SF_SMALL)
    star = FT.build_star(trips, stage_input=False)
    plan = star.fact._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert "Exchange" not in star.datetime._jdf.queryExecution().executedPlan().toString()


def test_per_row_equals_the_join(spark):
    trips = _random_trips(spark, 150)
    loc, pay, pas = D.location_dim(trips), D.payment_dim(trips), D.passenger_dim(trips)
    dims = D.datetime_dim(trips, grain="per_row")
    for null_keys in ("drop", "match"):
        got = FT.build_per_row(trips, dims, loc, pay, pas, null_keys)
        assert _same(got, FT.build(trips, dims, loc, pay, pas, null_keys))
    shuffled = dims.withColumn("datetime_id", F.col("datetime_id") * 2)
    with pytest.raises(Exception, match="not in a row"):
        FT.build_per_row(trips, shuffled, loc, pay, pas).count()


def test_a_pair_with_a_third_of_the_trips_is_dealt_out(spark, monkeypatch):
    """3000 trips share a pair: 9 million facts of it, made by all tasks alike."""
    monkeypatch.setattr(FT, "RANGE", 64)
    hot = spark.range(3000).select(F.lit(1).cast("long").alias("_low"), F.lit(3000).cast("long").alias("_k"), F.col("id").alias(O.SEQUENCE))
    cold = spark.range(6000).select((F.col("id") + 5000).alias("_low"), F.lit(1).cast("long").alias("_k"), (F.col("id") + 3000).alias(O.SEQUENCE))
    out = FT._unfolded(hot.unionAll(cold))
    per = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(per) == 9_000_000 + 6000 and max(per) < 1.2 * sum(per) / len(per) and len(per) > 1
    assert out.where("_k = 1").agg(F.count_distinct("datetime_id"), F.min("datetime_id")).first() == (6000, 5000)


def test_uniqueness_is_proved_from_borders(spark):
    star = FT.build_star(_trips(spark, SF_SMALL), stage_input=False)
    for df, key in ((star.fact, "trip_id"), (star.datetime, "datetime_id"), (star.location, "location_id")):
        assert Q._unproven(df, key).first()["unproven"] is False
        assert [r["failures"] for r in Q.check_unique(df, key).collect()] == [0, 0]
        runs = Q.key_runs(df, key).collect()
        assert all(r["run"] and r["high"] - r["low"] + 1 == r["n"] for r in runs if r["n"])


def test_what_is_not_a_run_is_counted(spark, tmp_path):
    def check(name, ids):
        spark.createDataFrame([(i,) for i in ids], "k long").repartition(1).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        return Q._unproven(df, "k").first()["unproven"], [r["failures"] for r in Q.check_unique(df, "k").collect()]

    assert check("repeated", [1, 2, 2, 3, None]) == (True, [1, 1])
    assert check("gaps", [5, 9, 1]) == (True, [0, 0])
    assert check("empty", []) == (False, [0, 0])
    one, two = spark.range(0, 10, 1, 1), spark.range(5, 15, 1, 1)
    for k, df in enumerate((one, two)):
        df.write.parquet(f"{tmp_path}/meet{k}")
    both = spark.read.parquet(f"{tmp_path}/meet0", f"{tmp_path}/meet1")
    assert Q._unproven(both, "id").first()["unproven"] is True
    assert [r["failures"] for r in Q.check_unique(both, "id").collect()] == [5, 0]
