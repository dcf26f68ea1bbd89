"""Randomised differential test: random trips (NULL keys, equal timestamp
pairs, duplicate rows, unknown codes) through the Spark star and marts, and
through the same semantics written as SQL in DuckDB."""

from __future__ import annotations

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.operators import facts as FT
from starmart.operators import marts as M
from starmart.plans import oracle_sql as O
from starmart.schema import TRIPS_COORD
from tools.compare import rows_of

BASE = dt.datetime(2024, 2, 28, 22, 0, 0)

trip = st.tuples(
    st.sampled_from([0, 0, 30, 3600, 7200, 86400]),            # pickup offset (s): many equal pairs
    st.sampled_from([600, 600, 900, 2.5, 1800]),                # duration (s), one fractional
    st.sampled_from([40.5, 40.25]), st.sampled_from([-74.0, -73.5]),
    st.one_of(st.none(), st.integers(0, 3)),                    # passenger count
    st.one_of(st.none(), st.integers(1, 6)),                    # payment code
    st.sampled_from([0.0, 1.5, 8.0, 20.0]),                     # fare
    st.sampled_from([0.0, 0.5, 2.0]),                           # tip
)


def _frame(spark, rows):
    out = []
    for off, dur, lat, lon, pas, pay, fare, tip in rows:
        p = None if off == 86400 else BASE + dt.timedelta(seconds=off)  # one NULL pickup value
        d = (p or BASE) + dt.timedelta(seconds=dur)
        out.append((p, d, lat, lon, lat + 0.25, lon + 0.5, pas, fare / 4, fare, tip, fare + tip, pay))
    return spark.createDataFrame(out, TRIPS_COORD), pd.DataFrame(out, columns=TRIPS_COORD.fieldNames())


def _compare(df, con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, rel.fetchall())


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=25), st.sampled_from(["distinct", "per_row"]), st.sampled_from(["drop", "match"]))
def test_random_star_matches_sql(spark, rows, grain, null_keys):
    sdf, pdf = _frame(spark, rows)
    con = duckdb.connect()
    con.register("trips_pdf", pdf)
    con.execute(
        "CREATE TABLE trips_input AS SELECT CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime, "
        "CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_datetime, pickup_latitude, pickup_longitude, "
        "dropoff_latitude, dropoff_longitude, CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance, "
        "fare_amount, tip_amount, total_amount, CAST(payment_type AS BIGINT) AS payment_type FROM trips_pdf"
    )
    star = FT.build_star(sdf, grain=grain, null_keys=null_keys)
    with_star = O.star_with(grain, null_keys, trips_table="trips_input")
    _compare(star.fact, con, with_star + "\nSELECT * FROM fact")
    _compare(star.datetime, con, with_star + "\nSELECT * FROM dt")
    _compare(M.hourly(star.fact, star.datetime), con, with_star + O.MART_HOURLY)
    _compare(M.daily(star.fact, star.datetime), con, with_star + O.MART_DAILY)
    _compare(M.popular_locations(star.fact, star.location), con, with_star + O.MART_LOCATIONS)
    _compare(M.payment_distribution(star.fact, star.payment), con, with_star + O.PAYMENT_DISTRIBUTION)
