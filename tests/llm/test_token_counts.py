import json
import random

import pytest
from pyspark.sql import functions as F
from starmart.llm import token_counts as C
from starmart.llm.queries import byte_tokenizer, op12_token_counts
from tokenizers import Tokenizer

PARTS = ["a", "s", "t", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "é", "ß", "中文", "1", "23", "½", "!", "...", "<", "|", "<|endoftext|>",
         "<|endof", "the", "ing", " The", " ", "　", " ", "\x85", "\x00", "😀", "re", "ll", "l", "v", "ve", "́", "‍",
         "x" * 30, "=" * 20, " " * 17, "ا", "१", "Ⅻ", "", "\U0010ffff"]


@pytest.fixture(scope="module")
def spec():
    with open(byte_tokenizer(), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def machine(spec):
    return C.Transducer(spec)


@pytest.fixture(scope="module")
def library(spec):
    t = Tokenizer.from_str(spec)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def texts(seed, n, parts, most):
    draw = random.Random(seed)
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(most))) for _ in range(n)]


def test_equals_the_library_on_mixtures(machine, library):
    some = texts(1, 20000, PARTS, 16) + texts(2, 3000, [chr(c) for c in range(33, 127)], 40) + texts(3, 2000, ["a", "e", " ", "\n", "'"], 60)
    assert [machine.count(t) for t in some] == library(some)


def test_equals_the_library_on_every_character(machine, library):
    some = [f"a{c}b 1{c}2{c}{c} {c}x'{c}" for c in map(chr, [*range(0x3000), *range(0xAC00, 0xAC40), *range(0xF900, 0x10000), *range(0x1F300, 0x1F700)])
            if not 0xD800 <= ord(c) < 0xE000]
    assert [machine.count(t) for t in some] == library(some)


def test_equals_the_library_on_every_token(machine, library, spec):
    vocab = json.loads(spec)["model"]["vocab"]
    some = [t.replace("Ġ", " ") for t in vocab if t.isascii() or set(t) <= {"Ġ"} | set(map(chr, range(128)))]
    assert [machine.count(t) for t in some] == library(some)


def test_forgetting_changes_nothing(spec, library, monkeypatch):
    monkeypatch.setattr(C, "MOST", 50)
    machine = C.Transducer(spec)
    some = texts(4, 300, PARTS, 30)
    assert [machine.count(t) for t in some] == library(some) and machine.size <= 50 and len(machine.states) <= 101


def test_state_maps_compose(machine):
    draw = random.Random(5)
    for t in texts(6, 600, PARTS, 60) + ["x" * 500, "<|endoftext|>" * 40, " " * 300, "'re" * 90]:
        want, size = machine.count(t), draw.randrange(1, 9)
        maps = [machine.map_of(t[i : i + size], i == 0) for i in range(0, len(t), size)]
        while len(maps) > 1:  # in any grouping
            k = draw.randrange(len(maps) - 1)
            maps[k : k + 2] = [machine.join(maps[k], maps[k + 1])]
        assert not maps or (maps[0].n, maps[0].head) == (want, "")


def test_annotations_are_differences_of_counts(machine, library):
    text = "They're  counting <|endoftext|> tokens'll\n do\t\t1234 naïve"
    total = 0
    state = machine.state(machine.start)
    for i, c in enumerate(text):
        state, n = state[c]
        total += n
        assert [total] == library([text[: i + 1]])


def test_only_plain_files_are_compiled(spec):
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": json.loads(spec)["added_tokens"] * 2}):
        with pytest.raises(ValueError):
            C.Transducer(json.dumps(json.loads(spec) | change))


def test_rows_long_texts_and_clashing_names(spark, docs_of, library):
    text = "some words, 'nd more of  them \n"
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, text, None, None), (3, text, None, None), (None, text * 3, "en", "b"),
            (4, text * 400, "en", "a"), (4, text * 400, "en", "a"), (5, "y" * 5000, "en", "a"), (6, " " * 3000 + "z", "en", "a"), (7, "<|endoftext|>" * 300, "a", "a")]
    df = docs_of(rows).withColumn("n_tokens", F.lit("x")).withColumn("_row", F.lit("y")).withColumn("_part", F.lit(0))
    for chunk in (1 << 16, 100):
        out = C.count_tokens(df, byte_tokenizer(), chunk=chunk)
        assert out.columns == [*df.columns, "_n_tokens"]
        got = sorted((str(r["doc_id"]), r["text"] or "", r["_n_tokens"]) for r in out.collect())
        assert got == sorted((str(i), t or "", n) for (i, t, _, _), n in zip(rows, library([r[1] or "" for r in rows]), strict=True))


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    given = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in op12_token_counts(spark, sf).collect()}
    assert got == {i: (len(t.encode()), n, n > 512) for (i, t), n in zip(given.items(), library(list(given.values())), strict=True)}
    assert any(x[2] for x in got.values()) and not all(x[2] for x in got.values())


def test_query_on_nothing(spark, tables, docs_of):
    assert op12_token_counts(spark, tables(documents=docs_of([]))).count() == 0
