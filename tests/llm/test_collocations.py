import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from starmart.llm import collocations as C
from starmart.llm.queries import ORACLE, op11_collocations
from tools.compare import duck, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, best=2000):
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    many = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = {(p[0], *p[i:j]) for p, a in many.items() for i in range(1, len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) - 1 and 100 * a >= 100 * f[(p[0], *p[i:j])]}
    found = defaultdict(list)
    for p, a in many.items():
        if p not in gone:
            cuts = [(f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
            score, _, (l, r) = min((1000 * a * n[p[0]] // (l * r), k, (l, r)) for k, (l, r) in enumerate(cuts))
            found[p[0]].append((-score, -a, " ".join(p[1:]).encode(), l, r))
    return {(lang, i, ph.decode(), -a, l, r, n[lang], -s)
            for lang, x in found.items() for i, (s, a, ph, l, r) in enumerate(sorted(x)[:best], 1)}


def rows(df):
    got = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


CASES = [
    (1, "A b c d e f. a B c d e f! a b", "en", "s"), (1, "A b c d e f. a B c d e f! a b", "en", "s"),
    (2, "\ta b  c\x00 d\x01 b c\x00 d\x01\nx\x0by\x0cx\ry É É é É É é", "en", None), (3, None, "en", "s"), (4, "", None, "s"),
    (None, "a b a b a b a b a b a b", None, "s"), (5, " .,;!?\t\n", "fr", "s"), (6, "a b a b", "und", "s"),
    (7, "x y z " * 4000, "de", "s"), (8, "w" * 300 + " q " + "w" * 300 + " q", "d\x00e", "s"), (9, "p\x01 q p\x01 q p q p q", "d\x01e", "s"),
]


def test_cases_equal_brute_force(spark, docs_of):
    docs = docs_of(CASES).withColumn("key", F.lit(1)).withColumn("phrase", F.lit("x"))
    for least, best in ((2, 2000), (1, 7)):
        assert rows(C.collocations(docs, least, best)) == brute(CASES, least, best)


def test_runs_over_blocks_tables_and_partitions(monkeypatch):
    """The passes by themselves, with everything cut small."""
    import random

    draw = random.Random(5)
    some = [(i, " ".join(draw.choice("abcd") + draw.choice(". ") * (draw.random() < 0.1) for _ in range(draw.randrange(90))),
             draw.choice(["en", "en", "fr", None]), "s") for i in range(120)]
    some += [(1000 + i, "the same long line of words " * 3, "en", "s") for i in range(100)]
    for name, value in (("BLOCK", 300), ("GATHER", 7), ("ROWS", 11), ("WIDE", 4)):
        monkeypatch.setattr(C, name, value)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in some]), pa.array([r[1] for r in some])], names=["lang", "text"])
    every = np.full(C.BITS // 8, 255, dtype=np.uint8)
    stream = sorted((k, n) for b in C._windows(every, iter([batch])) for k, n in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True))
    want = Counter()
    for _, text, lang, _ in some:
        for piece in re.split("[.]", text):
            w = piece.split()
            want.update((lang or "und", " ".join(w[i : i + k]), k) for k in range(3, 6) for i in range(len(w) - k + 1))
    want = {k: n for k, n in want.items() if n >= 5}
    for size in (1, 13, 500, len(stream)):
        got, told = Counter(), 0
        for i in range(0, len(stream), size):
            part = stream[i : i + size]
            cut = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in part[j : j + 5]], pa.binary()), pa.array([n for _, n in part[j : j + 5]])],
                                              names=["key", "n"]) for j in range(0, len(part), 5)]
            for b in C._phrase_counts(5)(iter(cut)):
                told += b.num_rows
                for lang, phrase, words, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    got[(lang, phrase, words)] += n
        assert {k: n for k, n in got.items() if n >= 5} == want
    # In one partition only what is frequent or touches its ends is told.
    assert told <= len(want) + 10


def _bitmap_of(keys):
    out = np.zeros(C.BITS // 8, dtype=np.uint8)
    batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])
    for bit in next(C._bits(iter([batch])))[0].to_pylist():
        out[bit >> 3] |= 1 << (bit & 7)
    return out


def _read(batches):
    return {k: n for b in batches for k, n in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True)}


def test_what_is_rare_ends_pairs_and_windows():
    docs = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b rare c d a b c, a b c d"])], names=["lang", "text"])
    words = _bitmap_of([b"en\x00" + bytes([w]) for w in b"abcd"])
    assert _read(C._count_pairs(words, iter([docs]))) == {
        b"en\x00a\x00b": 3, b"en\x00c\x00d": 2, b"en\x00d\x00a": 1, b"en\x00b\x00c": 2}
    pairs = _bitmap_of([b"en\x00a\x00b", b"en\x00b\x00c", b"en\x00d\x00a", b"fr\x00c\x00d"])
    assert _read(C._windows(pairs, iter([docs]))) == {b"en\x00d\x00a\x00b\x00c": 1, b"en\x00a\x00b\x00c": 2}


def test_scores_pass_64_bits(spark):
    x = spark.createDataFrame([(10**16, 9 * 10**16, 3 * 10**15, 7 * 10**15)], "a long, n long, l long, r long")
    got = x.select(C._score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert got == 1000 * 10**16 * 9 * 10**16 // (3 * 10**15 * 7 * 10**15)


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 64)
    text = "one two three. four five " * 40
    parts = list(C._slices([text]))
    assert len(parts) > 5 and b"".join(parts) == text.encode() and all(p.endswith(b".") for p in parts[:-1])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    df = op11_collocations(spark, sf)
    rel = duck(sf).execute(ORACLE["op11_collocations"])
    assert df.count() > 20
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in rel.description], rel.fetchall())


def test_query_on_nothing(spark, tables, docs_of):
    assert op11_collocations(spark, tables(documents=docs_of([]))).count() == 0


@pytest.mark.parametrize("column", ["text", "lang"])
def test_only_text_and_label_are_read(spark, docs_of, column):
    assert C.collocations(docs_of([(None, None, None, None)]).select("text", "lang"), 1).count() == 0
