import bisect
import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from starmart.checkpoint import app_root, scratch_scope
from starmart.llm import suffix_dedup as S
from starmart.llm.queries import op9_suffix_dedup


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) by counting every string."""
    data, count = [(t or "").encode() for t in texts], {}
    for d in data:
        for p in range(len(d) - length + 1):
            w = d[p : p + length]
            count[w] = count.get(w, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=int)
        for p in range(len(d) - length + 1):
            if count[d[p : p + length]] > 1:
                gone[p : p + length] = 1
        gone[-1] = 0
        kept = bytes(b for b, g in zip(d, gone[:-1], strict=True) if not g)
        spans = int(((gone[1:] == 0) & (gone[:-1] == 1)).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, texts, length, parts=4):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
    rows = S.remove_repeats(df, length=length, with_text=True).collect()
    for r in rows:
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert sum(j - i for i, j in r["removed"]) == r["n_removed"]
    return [tuple(r)[1:5] for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("slice_", [S._SLICE, 64])
def test_every_window_has_one_anchor_that_its_text_decides(monkeypatch, slice_):
    monkeypatch.setattr(S, "_SLICE", slice_)
    S._tables.cache_clear()
    rng = random.Random(1)
    text = bytes(rng.choice(b"ab") for _ in range(500)) + b"x" * 90 + bytes(rng.choice(b"abcdefgh") for _ in range(700))
    length, seen, place = 40, {}, {}
    for a, suffix, before in S.contexts(text, length):
        for d in range(length - len(suffix), len(before) + 1):
            p = a - d
            assert p not in seen and text[p : p + length] == before[:d][::-1] + suffix[: length - d]
            seen[p] = d
            assert place.setdefault(text[p : p + length], d) == d
    assert sorted(seen) == list(range(len(text) - length + 1))
    S._tables.cache_clear()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=12, unique=True), min_size=1, max_size=7))
def test_merge_sorts_and_knows_common_prefixes(lists):
    runs = [(sorted(x), S.prefix_lengths(sorted(x))) for x in lists]
    got = [(runs[r][0][n], c) for r, n, c in S.merge(runs)]
    keys = sorted(k for x in lists for k in x)
    assert [k for k, _ in got] == keys
    for (a, _), (b, c) in zip(got, got[1:], strict=False):
        assert c == S.common(a, b)


def test_merge_compares_no_known_prefix(monkeypatch):
    """Of keys with a long common prefix, its bytes are read once for each run."""
    real, seen = S.common, []

    def counted(a, b, known=0):
        out = real(a, b, known)
        seen.append(out - known)
        return out

    monkeypatch.setattr(S, "common", counted)
    keys = [b"p" * 5000 + i.to_bytes(2, "big") for i in range(400)]
    runs = [(keys[i::8], S.prefix_lengths(keys[i::8])) for i in range(8)]
    assert len(list(S.merge(runs))) == 400
    assert sum(seen) < 5000 * 8 + 400 * 8


def test_front_coding_round_trip():
    rng = np.random.default_rng(2)
    keys = sorted({bytes(rng.integers(0, 3, rng.integers(1, 60), dtype=np.uint8)) for _ in range(5000)})
    ids = rng.integers(-(2**31), 2**31, (len(keys), 4))
    flags = rng.integers(0, 4, len(keys)).tolist()
    k, c, f, i = S.decode(S.encode(keys, flags, ids))
    assert k == keys and f == flags and (i == ids).all()
    assert c == [0] + [S.common(a, b) for a, b in zip(keys, keys[1:], strict=False)]


def texts_of(seed, length):
    """Documents that share passages, edits, periods and edges in many ways."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    pool = [word(rng.randrange(length // 2, 4 * length)) for _ in range(6)]
    out = [None, "", "a" * (3 * length), "ab" * (2 * length), word(length - 1)]
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            x = rng.choice(pool)
            kind = rng.randrange(6)
            if kind == 1:
                x = x[rng.randrange(len(x)) :]
            elif kind == 2:
                i = rng.randrange(len(x))
                x = x[:i] + rng.choice("xyz") + x[i + 1 :]
            elif kind == 3:
                x = word(rng.randrange(1, length))
            elif kind == 4:
                x = x[: rng.randrange(len(x))] + x[rng.randrange(len(x)) :]
            parts.append(x)
        out.append("".join(parts))
    return out + out[5:8] + [out[9]] * 5


@pytest.mark.parametrize(("seed", "length"), [(1, 20), (2, 24), (3, 33), (4, 60)])
def test_equals_brute_force(spark, monkeypatch, seed, length):
    texts = texts_of(seed, length)
    assert run(spark, texts, length) == brute(texts, length)


def test_open_windows_are_listed(spark):
    """The best right and the best left neighbour differ, and a third repeats what is between."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    length = 60
    x = word(200)
    texts = [x]
    for cut in range(20, 180, 7):
        texts += [word(30) + x[cut : cut + length + 3] + word(30), word(30) + x[:cut] + word(30), word(30) + x[cut:] + word(30)]
    for cut in range(40, 140, 5):
        texts.append(word(20) + x[cut - 35 : cut + 31] + word(20))
    assert run(spark, texts, length) == brute(texts, length)
    many = texts + [x[a : a + length + b] for a in range(0, 120, 11) for b in (0, 1, 5)]
    assert run(spark, many, length, 7) == brute(many, length)


def test_query(spark, docs_of, tables):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    passage = word(260)
    rows = [(i, word(300) + (passage if i % 3 == 0 else "") + word(200), "en", "a") for i in range(30)]
    rows += [(50, None, None, None), (51, "", "en", "a"), (52, "é" * 4000, "en", "a"), (None, rows[1][1], "en", "a"), (2, rows[2][1], "en", "a"), (53, word(40_000), "en", "a")]
    out = op9_suffix_dedup(spark, tables(documents=docs_of(rows))).collect()
    want = brute([t for _, t, _, _ in rows], 200)
    assert sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in out) == sorted((str(d[0]), *w) for d, w in zip(rows, want, strict=True))
    assert op9_suffix_dedup(spark, tables(documents=docs_of([]))).count() == 0


def test_small_buckets_and_runs(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_BYTES", 4000)
    texts = texts_of(11, 30)
    assert run(spark, texts, 30, 9) == brute(texts, 30)


def test_few_long_documents_are_dealt_evenly(spark, docs_of, monkeypatch):
    """The first sort's sample follows bytes, not documents."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghij ", k=600_000)) for _ in range(4)]
    texts[0] = texts[0][:-300] + texts[3][:300]
    docs = docs_of([(i, t, "en", "a") for i, t in enumerate(texts)])
    seen = []
    plain = S._splitters
    monkeypatch.setattr(S, "_splitters", lambda keys, buckets: seen.append((keys.count(), buckets, plain(keys, buckets))) or seen[-1][2])
    out = {r["doc_id"]: r["n_removed"] for r in S.remove_repeats(docs).collect()}
    assert out == {0: 300, 1: 0, 2: 0, 3: 300}
    sample, buckets, splitters = seen[0]
    assert len(splitters) == buckets - 1 and sample <= 4 * S.SAMPLES * buckets
    keys = [x for t in texts for _, x, _ in S.contexts(t.encode())]
    sizes = np.bincount([bisect.bisect(splitters, k) for k in keys], minlength=buckets)
    assert sizes.max() < 3 * sizes.mean()


def test_parts_go_to_buckets_that_they_can_match():
    """A run of few keys makes few parts, however many buckets there are; keys beyond a border go along where they match it."""
    rng = random.Random(6)
    word = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    keys = sorted(word(60) + b"\xff" + word(40) for _ in range(10))
    ids = np.zeros((10, 4), dtype=np.int64)
    splitters = sorted(word(60) for _ in range(2000))
    parts = list(S._parts(keys, [0] * 10, ids, splitters, 16))
    assert [k for p in parts for k in S.decode(p[2])[0]] == keys and len(parts) <= 10
    for cut in (15, 16):
        near = sorted([keys[3][:cut] + b"a" * 10, keys[3][:cut] + b"i" * 10])
        flags = {b: S.decode(p)[2] for b, _, p in S._parts(keys, [0] * 10, ids, near, 16)}
        assert sum(f.count(S.GHOST) for f in flags.values()) == (2 if cut == 16 else 0)
        assert sum(len(f) - f.count(S.GHOST) for f in flags.values()) == 10


def test_rivals_share_more_than_the_gram(spark):
    """Of contexts with one gram, only those list windows that have an open one's place and core."""
    rng = random.Random(8)
    word = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    gram, length = word(16), 200
    texts = [(word(150), gram + word(130)) for _ in range(300)]
    texts += [(texts[0][0][:100] + word(50), texts[0][1])]
    schema = "k1 long, k2 int, low int, high int, anchor int, suffix binary, before binary"
    near = spark.createDataFrame([(n, 0, length - len(y), len(x), 500, y, x) for n, (x, y) in enumerate(texts)], schema)
    still = near.where("k1 = 0").withColumns({"low": F.lit(90), "high": F.lit(104)})
    got = S._rivals(near, still, length).collect()
    assert sorted({(r["k1"], r["low"]) for r in got}) == sorted((k, 500 - d) for k in (0, 300) for d in range(90, 105)) and len(got) == 30
    for r in got:
        x, y = texts[r["k1"]]
        d = 500 - r["low"]
        assert bytes(r["window"]) == x[:d][::-1] + y[: length - d]
    assert sorted(r["low"] for r in S._listed(near, still, length).collect()) == [500 - d for d in range(100, 89, -1)]


@pytest.mark.parametrize(("length", "slot"), [(200, 50), (60, 7), (30, 4)])
def test_open_windows_of_many_slots(spark, monkeypatch, length, slot):
    monkeypatch.setattr(S, "SLOT", slot)
    seen, plain = [], S._listed
    monkeypatch.setattr(S, "_listed", lambda near, still, n: seen.append(still.count()) or plain(near, still, n))
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    x = word(3 * length)
    texts = [x, x[: 2 * length] + word(9)]
    for cut in range(length // 10, 3 * length, max(3, length // 9)):
        low = max(0, cut - length // 2 - length // 7)
        texts += [word(30) + x[:cut] + word(30), word(30) + x[cut:] + word(30), word(20) + x[low : low + length + 2] + word(20)]
    assert run(spark, texts, length) == brute(texts, length)
    parts = [word(30) + x[a : a + n] + word(30) for a, n in ((rng.randrange(2 * length), rng.randrange(length // 2, 2 * length)) for _ in range(60))]
    assert run(spark, parts, length) == brute(parts, length)
    assert sum(seen) > 0


def test_sorts_leave_nothing_on_disk(spark, docs_of, tables):
    """When the spans are known, the sorts' tables and their shuffle files are gone."""
    rng = random.Random(13)
    texts = ["".join(rng.choices("abcdefghij ", k=400_000)) for _ in range(3)]
    x = texts[0][:1000]
    texts += ["y" * 9 + x[:cut] + "z" * 9 + x[cut - 90 :] for cut in range(100, 1000, 50)]
    stored = tables(documents=docs_of([(i, t, "en", "a") for i, t in enumerate(texts)]))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {p: p.stat().st_size for d in disk.localDirs() for p in Path(d.getPath()).rglob("shuffle_*")}
    with scratch_scope(spark):
        before = shuffled()
        op9_suffix_dedup(spark, stored)
        left = sum(n for p, n in shuffled().items() if p not in before)
        tables = [p for p in Path(app_root(spark).removeprefix("file:")).rglob("*") if p.suffix == ".parquet"]
    assert left < 50_000
    assert tables and {p.parent.name.rsplit("-", 1)[0] for p in tables} == {"suffix-windows"}
