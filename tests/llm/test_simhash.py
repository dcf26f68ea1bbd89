import random
import re

import xxhash
from pyspark.sql import functions as F
from starmart.llm.components import components
from starmart.llm.queries import op4_simhash
from starmart.llm.simhash import links, simhash


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits=2):
    """Component of each distinct value, by its smallest member."""
    fps, label = sorted(set(fps)), {}
    for x in fps:
        if x in label:
            continue
        stack, label[x] = [x], x
        while stack:
            a = stack.pop()
            for b in fps:
                if b not in label and bin((a ^ b) & (2**64 - 1)).count("1") <= bits:
                    label[b] = x
                    stack.append(b)
    return label


def test_simhash_matches_brute_force():
    for t in (None, "", "  \t\n", "One", "a b", "a b c", "A b C d\x0be", "é x É y z w", "wörd " * 5000, "x" * 200_000):
        assert simhash(t) == brute(t), t


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    fps = {0, 1, 3, 7, 2**64 - 1, 2**63, 2**63 + 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.randrange(6)):
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                x ^= 1 << b
            fps.add(x)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.root for r in components(links(df)).collect()}
    label = groups(signed)
    want = {}
    for x in signed:
        want.setdefault(label[x], set()).add(x)
    have = {}
    for x in signed:
        have.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, have.values())) == sorted(map(sorted, want.values()))
    assert any(len(v) > 3 for v in want.values())


def test_dense_ball_makes_no_pairs(spark):
    """All 2081 points within 2 bits of one: linear many links, one group."""
    c = 0x0F0F33335555AAAA
    ball = [c] + [c ^ 1 << i for i in range(64)] + [c ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)]
    ball = [x - 2**64 if x >> 63 else x for x in ball]
    edges = links(spark.createDataFrame([(x,) for x in ball], "fp long")).cache()
    assert edges.count() < 33 * 4 * len(ball)
    nodes = components(edges).agg(F.count("node"), F.countDistinct("root")).first()
    assert tuple(nodes) == (2081, 1)


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5000, 5000)], "u long, v long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000, 5000: 5000}
    assert components(e.limit(0)).count() == 0


def test_query_on_edge_rows(spark, docs_of, tables):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base, "en", "a"), (3, base + " tail", "en", "a"), (9, base.upper(), None, None), (1, None, None, None),
            (2, "", "en", "a"), (2, "", "en", "a"), (None, " \n", "en", "a"), (7, "short", "en", "a"), (8, "y " * 60_000, "en", "b")]
    sf = tables(documents=docs_of(rows).withColumn("component_id", F.lit("x")).withColumn("fp", F.lit(0)))
    out = op4_simhash(spark, sf).collect()
    label = groups([brute(t) for _, t, _, _ in rows])
    first = {}
    for d, t, _, _ in rows:
        k = label[brute(t)]
        first[k] = min(x for x in (first.get(k), d) if x is not None) if (d is not None or k in first) else None
    want = sorted(((d, f"{brute(t):016x}", first[label[brute(t)]]) for d, t, _, _ in rows), key=str)
    assert sorted((tuple(r) for r in out), key=str) == want
    assert op4_simhash(spark, tables(documents=docs_of([]))).count() == 0
