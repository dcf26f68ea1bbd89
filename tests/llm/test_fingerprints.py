import hashlib

import pytest
from pyspark.sql import functions as F
from starmart.llm import fingerprints as FP
from starmart.llm.queries import op3_fingerprints


def shingles(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_sketches_hold_what_is_below_the_threshold(spark, docs_of):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(300)) for i in range(1, 6)] + ["a b", "", None, "one", "\t\n", "X y z q r s"]
    docs = docs_of([(i, t, "en", "a") for i, t in enumerate(texts)])
    full = {r["doc_id"]: set(r["s"]) for r in FP.with_sketch(docs, F.col("text"), "s", scale=1).collect()}
    some = {r["doc_id"]: r["s"] for r in FP.with_sketch(docs, F.col("text"), "s").collect()}
    for i, t in enumerate(texts):
        assert len(full[i]) == len(shingles(t))
        held = {h for h in full[i] if h % (1 << 64) < 1 << 62} | ({min(full[i])} if full[i] else set())
        assert set(some[i]) == held and some[i] == sorted(some[i])


def test_merge_is_the_sketch_of_the_union(docs_of):
    docs = docs_of([(1, "a b c d e f g h i j", "en", "x"), (2, "k l m n o p q", "en", "x"), (3, "a b c d e f", "en", "y")])
    s = FP.with_sketch(docs, F.col("text"), "s", scale=1)
    got = {r["source"]: r["s"] for r in FP.merge(s, ["source"], "s", scale=1).collect()}
    parts = {r["doc_id"]: r["s"] for r in s.collect()}
    assert got["x"] == sorted(set(parts[1]) | set(parts[2])) and got["y"] == parts[3]


def test_containment_of_unequal_documents(docs_of):
    long = " ".join(f"w{j}" for j in range(4000))
    docs = docs_of([(1, long, "en", "x"), (2, " ".join(long.split()[100:500]), "en", "x"), (3, "other " * 50, "en", "x")])
    s = {r["doc_id"]: r["s"] for r in FP.with_sketch(docs, F.col("text"), "s").collect()}
    assert len(set(s[2]) & set(s[1])) >= 0.98 * len(s[2])
    assert not set(s[3]) & set(s[1])


def expected(rows):
    rows = sorted(((d, t or "") for d, t, _, _ in rows), key=lambda r: r[0])
    out = {}
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), e, nxt)
    return out


def test_query(spark, docs_of, tables):
    rows = [(i * i, " ".join(f"é{(i * k) % 53}" for k in range(20 + i * 9 % 90)), "en", "a") for i in range(60)]
    rows += [(5000, None, None, None), (5001, "", "en", "a"), (5002, "🎉" * 5, "en", "a"), (-7, rows[3][1], "en", "a"), (6000, "long words here " * 20_000, "en", "a"),
             (6001, rows[9][1], "en", "a"), (6002, rows[9][1], "en", "a")]
    out = {r["doc_id"]: r for r in op3_fingerprints(spark, tables(documents=docs_of(rows).withColumn("_at", F.lit(1)))).collect()}
    want = expected(rows)
    assert out.keys() == want.keys()
    for d, (n, sha, _, _) in want.items():
        assert (out[d]["n_chars"], out[d]["edited_sha256"]) == (n, sha), d
        assert 0 <= out[d]["near_edited"] <= 1 and 0 <= out[d]["near_next"] <= 1
    assert out[6001]["near_next"] == 1 and out[6001]["fingerprint"] == out[81]["fingerprint"]
    err = [abs(out[d]["near_edited"] - len(shingles(t) & shingles(want[d][2])) / max(1, min(len(shingles(t)), len(shingles(want[d][2])))))
           for d, t, _, _ in rows[20:60]]
    assert sum(err) / len(err) < 0.15


def test_successor_wraps_and_ties(spark):
    one = spark.createDataFrame([(4, "only")], "doc_id long, text string")
    assert [r["n"]["text"] for r in FP.with_next(one, "doc_id", F.lit(0), ["text"], "n").collect()] == ["only"]
    rows = [(None, "n")] + [(i, f"t{i}") for i in range(50)] + [(7, "z"), (7, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["n"]["text"]) for r in
                 FP.with_next(df, "doc_id", F.col("text"), ["text"], "n", bytes_per_bucket=16).collect())
    line = sorted((-1 if d is None else d, t) for d, t in rows)
    assert got == [(d, t, n) for (d, t), (_, n) in zip(line, line[1:] + line[:1], strict=True)]


def test_empty(spark, docs_of, tables):
    assert op3_fingerprints(spark, tables(documents=docs_of([]))).count() == 0


def test_main_path_is_native(spark, capsys):
    op3_fingerprints(spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "Window" in plan and not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_a_merged_sketch_holds_what_the_union_would(docs_of):
    """Many short texts and a long one: only one hash above the threshold stays."""
    rows = [(i, f"short text number {i} here", "en", "a") for i in range(40)] + [(99, " ".join(f"w{k}" for k in range(400)), "en", "a")]
    docs = docs_of(rows)
    every = {h for r in FP.with_sketch(docs, F.col("text"), "s", scale=1).collect() for h in r["s"]}
    want = sorted({h for h in every if (h % 2**64) >> 62 == 0} | {min(every)})
    (got,) = FP.merge(FP.with_sketch(docs, F.col("text"), "s", scale=4), ["source"], "s", scale=4).collect()
    assert got["s"] == want and sum((h % 2**64) >> 62 > 0 for h in want) <= 1
