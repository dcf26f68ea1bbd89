import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from starmart.llm import packing
from starmart.llm.queries import op2_packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


TEXTS = [
    None, "", " \n", "Hello, World!", "don't we'll it's 'quoted'", "naïve Ünïcödé straße ǅ İstanbul", "a\x1cb\x1f c",
    "<|endoftext|> x", "x1y2 3.14 ###&&& ---", "é combining ́alone", "日本語 テキスト", "tab\tnbsp em x\u0085y",
    "word. word, Word WORD! | wörd*** 'S", "🎉🎉 ok", "ª º µ ŉ",
]


def test_ids_equal_the_tokenizer(plain):
    words = packing.WordIds(PATH)
    for t in TEXTS + [" ".join(t or "" for t in TEXTS)]:
        assert np.frombuffer(words.ids(t), "<u4").tolist() == plain(t), t


def test_ids_survive_a_full_memory(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    words = packing.WordIds(PATH)
    for t in ["one two three four five", "one six, two seven", "one two"] * 3:
        assert np.frombuffer(words.ids(t), "<u4").tolist() == plain(t)


def optimum(items, size):
    """Fewest bins, by search."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b >= items[i]:
                k = list(bins)
                k.remove(b)
                go(i + 1, [*k, b - items[i]])
        go(i + 1, [*bins, size - items[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=8))
def test_fixed_sets_are_in_an_optimal_solution(items):
    counts = Counter(items)
    fixed, rest = packing.reduce_dominated(counts, 12)
    assert optimum(items, 12) == sum(n for _, n in fixed) + optimum(list(Counter(rest).elements()), 12)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=15))
def test_solutions_use_every_item_once(counts):
    used = Counter()
    for pattern, n in packing.solve(counts, 40):
        assert n > 0 and sum(s * k for s, k in pattern) <= 40
        for s, k in pattern:
            used[s] += k * n
    assert used == Counter(counts)


def test_close_to_the_bound():
    rng = random.Random(2)
    counts = Counter(min(2048, max(1, int(rng.lognormvariate(6.2, 0.9)))) for _ in range(100_000))
    bins = sum(n for _, n in packing.solve(counts, 2048))
    assert bins <= 1.002 * (sum(s * n for s, n in counts.items()) / 2048) + 1
    huge = {s: n * 10**7 for s, n in counts.items()}  # steps don't depend on the counts
    assert sum(n for _, n in packing.solve(huge, 2048)) <= 1.002 * sum(s * n for s, n in huge.items()) / 2048


def check_rows(out, docs, plain):
    bins, seen = defaultdict(list), defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]].append(r)
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    want = Counter()
    for d, t, _, _ in docs:
        ids = [*plain(t), 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            want[(d, k // 2048, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    return len(bins)


def test_query(spark, docs_of, tables, plain):
    docs = [(i, t, "en", "a") for i, t in enumerate(TEXTS)]
    docs += [(100 + i, "word " * (i * 37 % 2100), "en", "a") for i in range(60)]
    docs += [(500, "x y, " * 9000, None, None), (None, "no id", "en", "a"), (3, "Hello, World!", "en", "a"), (3, "Hello, World!", "en", "a")]
    sf = tables(documents=docs_of(docs))
    out = op2_packing(spark, sf).collect()
    bins = check_rows(out, docs, plain)
    total = sum(r["length"] for r in out)
    assert bins <= -(-total // 2048) + 3
    assert op2_packing(spark, tables(documents=docs_of([]))).count() == 0


def test_sequences_hold_the_ids(spark, docs_of, plain):
    docs = docs_of([(i, f"some words {i} " * (i % 9), "en", "a") for i in range(30)] + [(99, "long " * 3000, "en", "a")])
    p = packing.pack(packing.pieces(docs, PATH, with_ids=True))
    got = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in packing.sequences(p).collect()}
    for r in p.collect():
        assert got[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == np.frombuffer(bytes(r["ids"]), "<u4").tolist()
    assert sum(map(len, got.values())) == sum(len(plain(r["text"])) + 1 for r in docs.collect())


def test_bad_lengths_and_clashes(spark):
    df = spark.createDataFrame([(5, "x", 1)], "length int, offset string, sequence_id int")
    assert packing.pack(df).columns == ["length", "offset", "sequence_id", "_sequence_id", "_offset"]
    for bad in (0, 2049, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(bad,)], "length int"))


def test_windows_are_packed_apart(spark):
    import random

    draw = random.Random(4)
    rows = [(w, i, draw.choice([3, 7, 7, 7, 500, 1024, 2048])) for w in (0, 2, 5) for i in range(200)]
    df = spark.createDataFrame(rows, "w long, i int, length long").withColumn("offset", F.lit("x")).repartition(5)
    out = packing.pack_windows(df, "w", ["i"]).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["_offset"], r["length"], r["w"], r["i"]))
    assert sorted(bins) == list(range(len(bins))) and sorted((r["w"], r["i"], r["length"]) for r in out) == sorted(rows)
    for b in bins.values():
        assert len({w for _, _, w, _ in b}) == 1 and [o for o, _, _, _ in sorted(b)] == [sum(n for _, n, _, _ in sorted(b)[:k]) for k in range(len(b))]
        assert sum(n for _, n, _, _ in b) <= 2048
    first = [sorted(bins[k])[0][2] for k in sorted(bins)]
    assert first == sorted(first)
    for w in (0, 2, 5):
        total = sum(n for x, _, n in rows if x == w)
        assert len([1 for x in first if x == w]) <= -(-total // 2048) + 2
        # Equal lengths take their places in order.
        sevens = sorted((r["sequence_id"], r["_offset"], r["i"]) for r in out if r["w"] == w and r["length"] == 2048)
        assert [i for _, _, i in sevens] == sorted(i for _, _, i in sevens)
    with pytest.raises(Exception, match="windows must not be null"):
        packing.pack_windows(spark.createDataFrame([(None, 1, 5)], "w long, i int, length long"), "w", ["i"]).count()
    assert packing.pack_windows(df.limit(0), "w", ["i"]).count() == 0


def test_kept_columns_come_along(spark, docs_of):
    out = packing.pieces(docs_of([(1, "a " * 3000, "en", "s"), (2, None, None, None)]), PATH, keep=("source", "n_chars"))
    assert out.columns[-2:] == ["source", "n_chars"]
    assert Counter((r["doc_id"], r["source"], r["n_chars"]) for r in out.collect()) == {(1, "s", 6000): 2, (2, None, None): 1}
