"""The versioned store: whole stars only, appended batches, no member twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from star_data import SF_SMALL

from starmart.plans import append, build, load_star
from starmart.plans import pipeline as P
from starmart.plans.queries import FIRST_BATCH, _trips, trips_normalized
from starmart.sinks import versions as V
from starmart.sources.staging import stage

KEYS = {
    "dim_datetime": ["pickup_datetime", "dropoff_datetime"],
    "dim_location": ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"],
    "dim_payment": ["payment_type"],
    "dim_passenger": ["passenger_count"],
}


def _natural(star):
    """The facts with their members' keys instead of ids."""
    x = star.fact.drop("trip_id")
    for name, key in (("dim_datetime", "datetime_id"), ("dim_location", "location_id"), ("dim_payment", "payment_id"), ("dim_passenger", "passenger_id")):
        x = x.join(star.tables()[name].select(key, *KEYS[name]), key, "left").drop(key)
    return x


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_batches_hold_what_one_build_does(spark, tmp_path):
    trips = _trips(spark, SF_SMALL)
    root = str(tmp_path / "star")
    first = build(trips.where(FIRST_BATCH), root, versions=True)
    n, before = first.fact.count(), first.payment.collect()
    both = append(spark, trips.where(f"NOT ({FIRST_BATCH})"), root)
    whole = build(trips, str(tmp_path / "whole"))
    assert _same(_natural(both), _natural(whole))
    for name, keys in KEYS.items():
        dim = both.tables()[name]
        assert dim.select(*keys).distinct().count() == dim.count() == whole.tables()[name].count()
    ids = both.fact.agg(F.min("trip_id"), F.max("trip_id"), F.count_distinct("trip_id"), F.count("*")).first()
    assert tuple(ids) == (1, whole.fact.count(), whole.fact.count(), whole.fact.count())
    assert set(before) < set(both.payment.collect())
    # The version before is still there.
    assert load_star(spark, root, version=1).fact.count() == n and V.versions(spark, root) == [1, 2]
    assert V.version(spark, root).rows["fact_trips"] == whole.fact.count()


def test_appending_reads_no_stored_fact(spark, tmp_path, monkeypatch):
    trips = _trips(spark, SF_SMALL)
    root = str(tmp_path / "star")
    build(trips.where(FIRST_BATCH), root, versions=True)
    seen = []
    real = P.resolve_batch
    monkeypatch.setattr(P, "resolve_batch", lambda stored, *a, **k: seen.append(real({n: d for n, d in stored.items() if n != "fact_trips"}, *a, **k)) or seen[0])
    append(spark, trips.where(f"NOT ({FIRST_BATCH})"), root)
    assert "fact_trips" not in seen[0][0].fact._jdf.queryExecution().executedPlan().toString()


def test_a_run_that_dies_leaves_the_old_star(spark, hand, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    build(hand, root, versions=True)
    before = sorted(map(tuple, load_star(spark, root).fact.collect()))
    real = V.write_table

    def dies(df, where, name, variant):
        if name == "fact_trips":
            raise RuntimeError("killed")
        return real(df, where, name, variant)

    monkeypatch.setattr(V, "write_table", dies)
    for work in (lambda: build(hand.limit(2), root, versions=True), lambda: append(spark, hand, root)):
        with pytest.raises(RuntimeError, match="killed"):
            work()
        assert V.versions(spark, root) == [1] and sorted(map(tuple, load_star(spark, root).fact.collect())) == before
    monkeypatch.undo()
    assert build(hand.limit(2), root, versions=True).fact.count() == load_star(spark, root).fact.count() == 2


def test_a_failing_check_keeps_the_version_back(spark, hand, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    build(hand, root, versions=True)
    monkeypatch.setattr(P.Q, "run_checks", lambda *a, **k: (_ for _ in ()).throw(P.Q.CheckFailed([("unique", "x", 1)])))
    with pytest.raises(P.Q.CheckFailed):
        append(spark, hand, root)
    assert V.versions(spark, root) == [1]


def test_versions_and_conflicts(spark, tmp_path):
    root = str(tmp_path)
    assert V.version(spark, root) is None and V.versions(spark, root) == []
    V.commit(spark, root, V.Version(1, "coords"))
    with pytest.raises(V.VersionConflict):
        V.commit(spark, root, V.Version(1, "coords"))
    (tmp_path / "_versions" / "00000002.json").write_text('{"number": 2, "var')  # a writer that died in the middle
    assert V.version(spark, root).number == 1


def test_zone_star_and_empty_batches(spark, tmp_path):
    trips = stage(trips_normalized(spark, SF_SMALL))
    root = str(tmp_path / "zones")
    one = "payment_type < 4"
    build(trips.where(one), root, variant="zones", versions=True)
    n = load_star(spark, root).fact.count()
    assert append(spark, trips.limit(0), root).fact.count() == n
    both = append(spark, trips.where(f"NOT coalesce({one}, false)"), root)
    assert both.variant == "zones" and both.fact.count() == trips.count() == both.datetime.count()
    assert both.payment.count() == trips.select("payment_type").distinct().count()
    ids = both.fact.agg(F.min("trip_id"), F.max("trip_id"), F.count_distinct("trip_id")).first()
    assert tuple(ids) == (0, trips.count() - 1, trips.count())


def test_refusals(spark, hand, tmp_path):
    with pytest.raises(ValueError, match="no versioned star"):
        append(spark, hand, str(tmp_path / "none"))
    build(hand, str(tmp_path / "per_row"), grain="per_row", versions=True)
    with pytest.raises(ValueError, match="per-row"):
        append(spark, hand, str(tmp_path / "per_row"))
    with pytest.raises(ValueError, match="versioned"):
        build(hand, str(tmp_path / "x"), versions=True, mode="append")


def test_command_line(spark, hand, tmp_path):
    from starmart.__main__ import main

    for k in (1, 2):
        hand.write.parquet(str(tmp_path / f"batch{k}"))
    star = str(tmp_path / "star")
    main(["build", "--input", str(tmp_path / "batch1"), "--source", "staged", "--star", star, "--versions"], spark)
    main(["append", "--input", str(tmp_path / "batch2"), "--source", "staged", "--star", star], spark)
    loaded = load_star(spark, star)
    assert loaded.fact.count() == 2 * load_star(spark, star, version=1).fact.count() and loaded.payment.count() == load_star(spark, star, version=1).payment.count()
