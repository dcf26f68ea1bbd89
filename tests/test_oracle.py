"""Every registered query against its DuckDB oracle (exact multiset equality),
and the profiles against SQL with a tolerance on means of doubles."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from starmart.plans.oracle_sql import PROFILE_SQL
from starmart.plans.queries import QUERIES as STAR_QUERIES
from tools.compare import duck, rows_of

from star_data import SF_SMALL

# The star's queries; other registered ones have tests of their own.
QUERIES = {k: v for k, v in E.queries().items() if k in STAR_QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in STAR_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.execute(ORACLE[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(d_cols, rel.fetchall())


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(PROFILE_SQL))
def test_profile_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = {r["column"]: r.asDict() for r in df.collect()}
    rel = con.execute(PROFILE_SQL[name])
    cols = [d[0] for d in rel.description]
    want = {r[0]: dict(zip(cols, r)) for r in rel.fetchall()}
    assert got.keys() == want.keys()
    for c in want:
        for k in ("ordinal", "row_count", "null_count", "min", "max", "median"):
            assert got[c][k] == want[c][k], (c, k)
        assert _close(got[c]["mean"], want[c]["mean"]), c


def test_profile_matches_pandas(spark):
    """The reference computes its profile with pandas; compare with it."""
    from starmart.operators.profile import profile

    mart = QUERIES["mart_daily"](spark, SF_SMALL)
    pdf = mart.toPandas()  # a small mart, test only
    prof = {r["column"]: r for r in profile(mart).collect()}
    for c in pdf.columns:
        s = pdf[c].astype("float64")
        assert prof[c]["null_count"] == int(s.isnull().sum())
        assert prof[c]["min"] == float(s.min()) and prof[c]["max"] == float(s.max())
        assert prof[c]["median"] == float(s.median())
        assert math.isclose(prof[c]["mean"], float(s.mean()), rel_tol=1e-12)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["pickup_hour", "avg_fare", "num_trips", "avg_tip", "avg_total"]
    assert [r.pickup_hour for r in rows] == list(range(24))
