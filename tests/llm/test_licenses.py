import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from starmart.llm import licenses as L
from starmart.llm.queries import op5_licenses

WORDS = re.compile(r"[^\W_]+")


def sh(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute(text):
    """Licenses with a window of template size, a quarter more on both sides,
    that holds 80 % of the template's shingles, over all windows."""
    w = sh(WORDS.findall((text or "").lower()))
    out = {}
    for name, wording in L.TEMPLATES:
        t = set(sh(WORDS.findall(wording.lower())))
        n = len(sh(WORDS.findall(wording.lower())))
        slack = -(-n // 4)
        for s in range(max(1, len(w) - n + 1)):
            share = len(t & set(w[max(0, s - slack) : s + n + slack])) / len(t)
            if share >= 0.8:
                out.setdefault(name, []).append((share, s, s + n))
    # Of licenses found in the same place the best one counts.
    best = {k: max(v) for k, v in out.items()}
    return {k for k, (share, a, z) in best.items()
            if not any(o != k and share2 > share and min(z, z2) > max(a, a2) for o, (share2, a2, z2) in best.items())}


LONG = dict((k, v) for k, v in L.TEMPLATES if len(v) > 120)


def edited(wording, at):
    w = wording.split()
    return " ".join([*w[:at], "changed", *w[at + 1 :]])


ROWS = [
    (1, "text before. Released under the MIT License. And after", "en", "a"),
    (2, "released UNDER the\nmit   license", "en", "a"),
    (3, "This work is licensed under CC BY-NC 4.0.", "en", "a"),
    (4, "Licensed under the Apache Licence", "en", "a"),
    (5, "x " * 500 + LONG["MIT"] + " y" * 500, "en", "a"),
    (6, edited(LONG["MIT"], 30), "en", "a"),
    (7, edited(LONG["GPL-3.0"], 20), "en", "a"),
    (8, edited(edited(edited(LONG["GPL-3.0"], 8), 16), 28), "en", "a"),
    (9, "no license here at all, only words under the sun", "en", "a"),
    (10, None, None, None), (11, "", "en", "a"), (12, "MIT", "en", "a"),
    (None, "Released under the MIT License.", "en", "a"),
    (13, "This work is licensed under the GNU General Public License, version 3.", "en", "a"),
    (13, "This work is licensed under the GNU General Public License, version 3.", "en", "a"),
    (14, " ".join(["Released under the MIT License. other words in between them all"] * 300), "en", "a"),
    (15, "Licensed under the Apache License, Version 2.0. Then: Licensed under the Apache License, Version 2.0.", "en", "a"),
    (16, "word " * 60_000, "en", "a"),
]


def test_query_equals_brute_force(spark, docs_of, tables):
    sf = tables(documents=docs_of(ROWS).withColumn("row", F.lit("x")).withColumn("words", F.lit(1)).withColumn("license", F.lit(1)))
    out = op5_licenses(spark, sf).collect()
    got = Counter((str(r["doc_id"]), r["license"]) for r in out)
    want = {(str(d), name) for d, t, _, _ in ROWS for name in brute(t)}
    assert set(got) == want
    assert got["14", "MIT"] == 300 and got["15", "Apache-2.0"] == 2 and got["13", "GPL-3.0"] == 2
    for r in out:
        text = next(t for d, t, _, _ in ROWS if d == r["doc_id"])
        assert r["matched"].split() == WORDS.findall(text.lower())[r["begin_word"] : r["end_word"]]
        assert 0.8 <= r["containment"] <= 1
    place = {(r["doc_id"], r["license"]): (r["begin_word"], r["end_word"], r["containment"]) for r in out}
    assert place[1, "MIT"] == (2, 7, 1.0) and place[5, "MIT"][0] == 500


def test_probability():
    assert L.collision_probability(2 / 3) > 0.9998
    assert L.collision_probability(1.0) == 1


def test_empty(spark, docs_of, tables):
    assert op5_licenses(spark, tables(documents=docs_of([]))).count() == 0
    df = docs_of([(1, "Released under the MIT License.", "en", "a")])
    assert L.scan_licenses(df, templates=[("X", "too short")]).count() == 0


def test_all_license_lines_of_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = docs.where(F.col("text").rlike(r"(under the (MIT|Apache) License|General Public License, version 3|CC BY-NC 4)"))
    got = op5_licenses(spark, "/root/testdata/sf0.01")
    assert {r[0] for r in lines.select("doc_id").collect()} == {r[0] for r in got.select("doc_id").collect()}


def test_main_path_is_native(spark, capsys):
    op5_licenses(spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_related_licenses_are_told_apart(spark, docs_of):
    rows = [(i, f"Some words before. {wording} And some after it.", "en", "a") for i, (_, wording) in enumerate(L.TEMPLATES)]
    between = " and other words that stand between one notice and the next one " * 4
    rows.append((99, between.join(w for _, w in L.TEMPLATES[4:13]), "en", "a"))
    out = L.scan_licenses(docs_of(rows)).collect()
    for i, (name, _) in enumerate(L.TEMPLATES):
        assert [r["license"] for r in out if r["doc_id"] == i] == [name]
    assert {r["license"] for r in out if r["doc_id"] == 99} == {n for n, _ in L.TEMPLATES[4:13]}


def test_many_hits_of_a_long_text(spark, docs_of):
    """Rows hold a few template lengths each, not the whole text."""
    text = " ".join(f"Released under the MIT License. line {i}" for i in range(20_000))
    out = L.scan_licenses(docs_of([(1, text, "en", "a")], 1))
    wall = time.time()
    got = out.select("begin_word").collect()
    assert sorted(r["begin_word"] for r in got) == [7 * i for i in range(20_000)]
    assert time.time() - wall < 60
