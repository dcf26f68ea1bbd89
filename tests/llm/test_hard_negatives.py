import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from starmart.llm import hard_negatives as H
from starmart.llm.queries import ORACLE, op13_hard_negatives
from tools.compare import duck, rows_of


def brute(rows, anchor, best=5, lowest=80):
    seen, whole = set(), []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = (i, label, tuple(math.floor(256 * x) for x in v))
        if r not in seen:
            seen.add(r)
            whole.append(r)
    out = set()
    for i, label, v in whole:
        if not anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), j, other) for j, other, w in whole if len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2] == label and x[1] != i)[:best]:
            near = sorted(x for x in scored if x[2] != label and lowest * -s <= 100 * -x[0] <= 100 * -s)[:best]
            out |= {(i, p, k, j, -s, -t) for k, (t, j, _) in enumerate(near, 1)}
    return out


def rows(df):
    got = [tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def given(rng, n, dim, labels=3):
    return [(i, [round(rng.gauss(0.3, 1), 2) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("shape", [(1, 1, 1), (16, 16, 16), (33, 64, 70), (100, 65, 17), (0, 4, 5), (5, 0, 7), (64, 64, 64)])
@pytest.mark.parametrize("leaf", [1, 2, 16])
def test_strassen_is_exact(shape, leaf):
    m, k, n = shape
    rng = np.random.default_rng(m + k)
    a, b = rng.integers(-(2**27), 2**27, (m, k)), rng.integers(-(2**27), 2**27, (k, n))
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b.T] for r in a], dtype=object).reshape(m, n)
    assert (H.strassen(a, b, leaf) == want.astype(np.int64)).all()


def test_sums_that_wrap_around_come_right():
    """Intermediate sums of Strassen pass 64 bits here; the products don't."""
    a = np.full((4, 4), 2**30, dtype=np.int64)
    b = np.full((4, 4), 2**30 - 1, dtype=np.int64)
    assert (H.strassen(a, b, 1) == 4 * 2**30 * (2**30 - 1)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    some = given(rng, 300, 6)
    some += [some[3], some[50], (50, some[50][1], 9), (1000, [1.0, 2.0], 1), (1001, [1.0, 2.1], 1), (1002, [1.0, 1.9], 2)]
    some += [(2000, None, 1), (2100, [1.0, None] * 3, 1), (2200, [float("nan")] * 6, 1), (2300, [float("inf")] * 6, 0), (2400, [0.5] * 6, None)]
    some += [(None, [0.5] * 6, 1), (2500, [], 1), (2600, [], 1), (2700, [], 2), (2800, [0.0] * 6, 1), (3000, [-1.0] * 6, 1)]
    df = spark.createDataFrame(some, "vec_id long, embedding array<double>, label int").withColumn("rank", F.lit(1)).withColumn("_asked", F.lit("x"))
    got = rows(H.hard_negatives(df.repartition(4), F.col("vec_id") % 50 == 0))
    assert got == brute(some, lambda i: i % 50 == 0)


def test_many_tiles_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(H, "CANDIDATES", 40)
    monkeypatch.setattr(H, "ANCHORS", 7)
    rng = random.Random(3)
    some = given(rng, 200, 5, 2) + [(1000 + i, [1.0, 0.5, 0.5, 0.25, 1.5], i % 2) for i in range(100)]
    df = spark.createDataFrame(some, "vec_id long, embedding array<float>, label int")
    some = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in some]
    got = rows(H.hard_negatives(df, F.col("vec_id") % 20 == 0, positives=3, negatives=4, lowest=50))
    want = set()
    for r in brute(some, lambda i: i % 20 == 0, 4, 50):
        want.add(r)
    first3 = {(a, p) for a, p in {(r[0], r[1]) for r in brute(some, lambda i: i % 20 == 0, 3, 50)}}
    assert got == {r for r in want if (r[0], r[1]) in first3}


def test_too_long_vectors_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e9, 1e9], 1), (1, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too long for exact"):
        H.hard_negatives(df, F.col("vec_id") == 0).collect()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_sql(spark, sf):
    df = op13_hard_negatives(spark, f"/root/testdata/{sf}")
    rel = duck(f"/root/testdata/{sf}").execute(ORACLE["op13_hard_negatives"])
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    assert want and rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_query_on_nothing(spark, tables):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op13_hard_negatives(spark, tables(embeddings=df)).count() == 0
