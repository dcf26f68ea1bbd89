import zlib
from collections import Counter, defaultdict

import numpy as np
from starmart.llm.queries import op1_sharding
from starmart.llm.sharding import _hypergeometric, communication_matrix, shard_sizes, shuffle_shards

ROWS = [(i, f"text {i}" * (i % 7), "en", "a" if i % 3 else "b") for i in range(200)]
ROWS += [(None, None, None, None), (900, "", "en", None), (901, "é" * 50_000, "fr", "a")] + [(7, "text 7", "en", "a")] * 30


def test_matrix_has_exact_margins():
    counts, sizes = [5, 0, 17, 100, 1], shard_sizes(123, 16)
    m = communication_matrix(counts, sizes, 1)
    assert [sum(r) for r in m] == counts
    assert [sum(c) for c in zip(*m, strict=True)] == sizes
    assert max(sizes) - min(sizes) <= 1 and all(x >= 0 for r in m for x in r)


def test_large_draws_follow_the_law():
    rng = np.random.default_rng(3)
    good, bad, draws = 2 * 10**9, 6 * 10**9, 10_000
    got = np.array([_hypergeometric(rng, good, bad, draws) for _ in range(400)])
    assert abs(got.mean() - 2500) < 12 and 35 < got.std() < 52


def test_shards_are_exact_and_slots_gapless(docs_of):
    out = shuffle_shards(docs_of(ROWS, 5), 16).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((d, t) for d, t, _, _ in ROWS)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert len(by) == 16 and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_uniform_over_seeds(docs_of):
    """Each row meets each shard about equally often, whatever its partition."""
    docs = docs_of([(i, "x", "en", "a") for i in range(100)], 4).cache()
    seen = Counter()
    for seed in range(8):
        seen.update((r.doc_id, r["shard"]) for r in shuffle_shards(docs, 2, seed).collect())
    first = [seen[(i, 0)] for i in range(100)]
    assert sum(first) == 400 and len(set(first)) >= 5 and 45 <= sum(first[:12]) + sum(first[-13:]) <= 155


def test_clashing_names_and_empty(spark, docs_of):
    df = spark.createDataFrame([(1, "a", "b")], "shard int, slot string, _mid string")
    out = shuffle_shards(df, 4)
    assert out.columns == ["shard", "slot", "_mid", "_shard", "_slot"]
    assert [tuple(r) for r in out.collect()] == [(1, "a", "b", 0, 0)]
    assert shuffle_shards(docs_of([]), 16).count() == 0


def test_query(spark, docs_of, tables):
    out = op1_sharding(spark, tables(documents=docs_of(ROWS))).collect()
    assert len(out) == len(ROWS)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert {r["law"] for r in out} == {"rows"} and {r["grown_shard"] for r in out} == {None}
