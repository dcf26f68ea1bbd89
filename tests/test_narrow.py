"""What the star's steps shuffle and write: ids and measures, sorted once, nothing that borders prove."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from star_data import SF_SMALL

from starmart.operators import facts as FT
from starmart.operators import keys as K
from starmart.operators import onepass as O
from starmart.operators import quality as Q
from starmart.plans import pipeline as P
from starmart.plans import queries as QU
from starmart.schema import COORD_COLUMNS, TRIPS_ZONE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("grain", ["distinct", "per_row"])
def test_facts_are_sorted_by_ids(spark, monkeypatch, grain):
    seen = []
    for name in ("number_both", "dense_key"):
        real = getattr(FT, name)
        monkeypatch.setattr(FT, name, lambda df, *a, real=real, **k: seen.append(df.columns) or real(df, *a, **k))
    FT.build_star(QU._trips(spark, SF_SMALL), grain=grain, stage_input=False)
    assert len(seen) == 1
    assert not {*COORD_COLUMNS, "passenger_count", "payment_type", "trip_duration"} & {*seen[0]}


def test_rows_read_from_files_are_sorted_once(spark):
    trips = O.materialize(QU.trips_normalized(spark, SF_SMALL), "zones")
    staging = TRIPS_ZONE.fieldNames()
    plan = _plan(K.numbered(trips, staging, unique=False))
    assert plan.count("Sort [") == 1
    assert _plan(K.numbered(trips.repartition(3), staging, unique=False)).count("Sort [") == 2


def test_only_what_is_kept_is_stored(spark, monkeypatch):
    stored = []
    real = K.materialize
    monkeypatch.setattr(K, "materialize", lambda df, *a, **k: stored.append(df.columns) or real(df, *a, **k))
    s, trips = QU.star(spark, SF_SMALL), QU._trips(spark, SF_SMALL)
    fact = FT.build(trips, s.datetime, s.location, s.payment, s.passenger)
    assert not {*trips.columns, O.SEQUENCE} & ({*stored[-1]} - {*fact.columns})
    assert fact.exceptAll(s.fact).count() == s.fact.exceptAll(fact).count() == 0


def test_ranges_grow_with_the_input(spark, monkeypatch):
    trips = QU._trips(spark, SF_SMALL)
    assert O.ranges_of(trips) is None and O.ranges_of(trips.distinct()) is None
    few = FT.build_star(trips, stage_input=False).fact
    monkeypatch.setattr(O, "RANGE_BYTES", 4096)
    want = O.ranges_of(trips)
    many = FT.build_star(trips, stage_input=False).fact
    assert want > 8
    assert many.select(F.input_file_name()).distinct().count() > few.select(F.input_file_name()).distinct().count()
    assert many.exceptAll(few).count() == few.exceptAll(many).count() == 0


def _ids(spark, path, ids):
    spark.createDataFrame([(i,) for i in ids], "datetime_id long").repartition(1).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize(
    ("facts", "dim", "unproven", "orphans"),
    [
        ([3, 3, None, 5], [1, 2, 3, 4, 5], False, 0),
        ([3, 6], [1, 2, 3, 4, 5], True, 1),
        ([0, 3, 0], [1, 2, 3, 4, 5], True, 2),
        ([3, 3, 2], [1, 2, 4, 5], True, 2),
        ([1, 2], [2, 1], True, 0),
        ([1, 2], [1, 2, None], False, 0),
        ([1], [], True, 1),
        ([None], [], False, 0),
        ([], [1], False, 0),
    ],
)
def test_orphans_are_ruled_out_by_borders(spark, tmp_path, facts, dim, unproven, orphans):
    fact, ids = _ids(spark, tmp_path / "f", facts), _ids(spark, tmp_path / "d", dim)
    assert Q._unmatched(fact, "datetime_id", ids, "datetime_id").first()["unproven"] is unproven
    found = Q.check_orphans(fact, {"dim_datetime": ids}, {"datetime_id": "dim_datetime"}).collect()
    assert [r["failures"] for r in found] == [orphans]


def test_a_gap_between_files_is_no_proof(spark, tmp_path):
    for k, (low, high) in enumerate(((1, 5), (7, 9))):
        spark.range(low, high, 1, 1).toDF("datetime_id").write.parquet(f"{tmp_path}/d{k}")
    ids = spark.read.parquet(f"{tmp_path}/d0", f"{tmp_path}/d1")
    fact = _ids(spark, tmp_path / "f", [1, 6, 6, 8])
    found = Q.check_orphans(fact, {"dim_datetime": ids}, {"datetime_id": "dim_datetime"}).collect()
    assert [r["failures"] for r in found] == [2]


def test_an_appended_batch_is_proved_against_the_whole_dimension(spark, monkeypatch, tmp_path):
    told = []
    real = Q._unmatched
    monkeypatch.setattr(Q, "_unmatched", lambda *a: told.append(real(*a)) or told[-1])
    trips = QU._trips(spark, SF_SMALL)
    P.build(trips.where("trip_distance < 6"), str(tmp_path), versions=True, stage_input=False)
    P.append(spark, trips.where("trip_distance >= 6"), str(tmp_path), stage_input=False)
    # The first build, and the batch against all members there are.
    assert [told[k].first()["unproven"] for k in (0, -1)] == [False, False]


def test_raw_csv_is_compressed(spark):
    QU.trips_from_csv(spark, SF_SMALL)
    folder = QU._memo(spark, SF_SMALL, "csv", str).removeprefix("file://").removeprefix("file:")
    assert {f.rsplit(".", 1)[-1] for f in os.listdir(folder) if f.startswith("part-")} == {"gz"}
