"""The exact median by selection, against sorting."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from starmart.operators import profile as P


def _median(values):
    some = [v for v in values if v is not None and v == v]
    return statistics.median(some) if some else None


def _columns(seed, n):
    draw = random.Random(seed)
    return {
        "normal": [draw.gauss(0, 1) for _ in range(n)],
        "ties": [float(draw.randrange(4)) for _ in range(n)],
        "hot": [0.5] * (n // 3) + [draw.random() for _ in range(n - n // 3)],
        "wide": [draw.choice([-1, 1]) * 10.0 ** draw.randrange(-300, 300) for _ in range(n)],
        "two": [-1e308] * (n // 2) + [1e308] * (n - n // 2),
        "holes": [draw.choice([None, float("nan"), float("inf"), float("-inf"), draw.random()]) for _ in range(n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("n", [1, 2, 3, 50, 2001])
@pytest.mark.parametrize("few, bins", [(4096, 1024), (3, 4)])
def test_equals_sorting(spark, monkeypatch, n, few, bins):
    monkeypatch.setattr(P, "FEW", few)
    monkeypatch.setattr(P, "BINS", bins)
    if few == 3 and n > 100:
        n = 300
    cols = _columns(n, n)
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = {r["column"]: r for r in P.profile(df, accuracy=20).collect()}
    for c, values in cols.items():
        want = _median(values)
        assert got[c]["median"] == want or want != want, c
        assert got[c]["null_count"] == sum(v is None or v != v for v in values) and got[c]["row_count"] == n


def test_a_wrong_bracket_is_widened(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"))
    assert P._select(df, {0: (1001, 900.0, 950.0)}) == {0: 501.0}
    assert P._select(df, {0: (1001, 10.0, 20.0)}) == {0: 501.0}


def test_no_table_sized_exchange(spark, tmp_path, monkeypatch):
    """Of 20,000 distinct values only the bracket's go through a shuffle."""
    spark.range(20_000).select((F.col("id") * 7919 % 20_000).cast("double").alias("v")).write.parquet(f"{tmp_path}/t")
    kept = []
    real = P.materialize
    monkeypatch.setattr(P, "materialize", lambda df, label="": kept.append((label, real(df, label))) or kept[-1][1])
    row = P.profile(spark.read.parquet(f"{tmp_path}/t")).collect()[0]
    assert row["median"] == 9999.5
    assert [label for label, _ in kept] == ["profile-bracket"] and kept[0][1].count() < 100


def test_kinds_of_columns(spark):
    df = spark.createDataFrame([(1, "a", True, 2**53, 1.5), (2, None, None, -5, 2.5)], "i int, s string, b boolean, l long, f float")
    got = {r["column"]: r for r in P.profile(df.withColumn("d", F.col("i").cast("decimal(10,2)"))).collect()}
    assert [got[c]["median"] for c in ("i", "s", "b", "l", "f", "d")] == [1.5, None, None, (2**53 - 5) / 2, 2.0, 1.5]
    assert got["s"]["null_count"] == 1 and [got[c]["ordinal"] for c in ("i", "s", "b", "l", "f", "d")] == list(range(6))
    assert P.profile(df.limit(0)).where("row_count = 0 and null_count = 0 and median is null").count() == 5
