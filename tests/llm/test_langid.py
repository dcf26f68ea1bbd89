import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from starmart.llm import langid
from starmart.llm.queries import op10_langid

WORDS = {"en": "the of and thing with which river stone", "de": "der die und schön über nicht straße", "fr": "le été où garçon avec les eaux"}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    out = []
    for i in range(240):
        lang = list(WORDS)[i % 3]
        out.append((i, " ".join(rng.choice(WORDS[lang].split(), 12)), lang, "s"))
    return out


@pytest.fixture(scope="module")
def model(docs_of, rows):
    return langid.train(docs_of(rows))


def slow_bits(model, text, k):
    """Code length by walking the context tree byte by byte, with dictionaries."""
    mine = [(int(c), int(n)) for la, c, n in zip(model.lang, model.code, model.count, strict=True) if la == k]
    tree = {}
    for c, n in mine:
        s = [c >> 18, c >> 12 & 63, c >> 6 & 63, c & 63]
        for order in range(4):
            node = tree.setdefault(tuple(s[3 - order : 3]), {})
            node[s[3]] = node.get(s[3], 0) + n
    weight = {}
    for c, n in zip(model.code, model.count, strict=True):
        weight[int(c) >> 6] = weight.get(int(c) >> 6, 0) + int(n)

    def p(context, sym):
        if len(context) == 3 and weight.get((context[0] * 64 + context[1]) * 64 + context[2], 0) < 2:
            return p(context[1:], sym)
        node = tree.get(context, {})
        n, d = sum(node.values()), len(node)
        if not n:
            return p(context[1:], sym) if context else 1 / 64
        if d == 64:
            return node[sym] / n
        if sym in node:
            return node[sym] / (n + d)
        lower = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / 64)
        return d / (n + d) * lower(sym) / (1 - sum(lower(x) for x in node))

    s = [int(model.to_symbol[32])] * 3 + [int(model.to_symbol[b]) for b in text.encode()]
    return -sum(np.log2(p(tuple(s[i - 3 : i]), s[i])) for i in range(3, len(s)))


def test_code_lengths_equal_a_walk_of_the_tree(model):
    for text in ("The river über 42 straße!", "été où", "zzqqxx ♥"):
        want = [slow_bits(model, text, k) for k in range(3)]
        assert np.allclose(model.code_lengths(text), want, rtol=1e-4)


def test_probabilities_sum_to_one(model):
    assert len(model.tables()) == 3
    for _, lengths in model.tables():
        assert np.allclose(np.exp2(-lengths.astype(float)).reshape(-1, 64).sum(1), 1, atol=1e-4)


def test_slices_do_not_change_the_sum(model, monkeypatch):
    text = "le garçon avec the river " * 40
    whole = model.code_lengths(text)
    monkeypatch.setattr(langid, "_SLICE", 7)
    assert np.allclose(model.code_lengths(text), whole, rtol=1e-5)


def test_edge_texts(spark, model):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 !?", "x"), (4, "the river " * 20_000, "x"), (5, "中", "x")],
                               "doc_id int, text string, lang_pred string")
    out = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert [out[i]["_lang_pred"] for i in (1, 2, 3, 4)] == ["und"] * 3 + ["en"]
    assert out[5]["_lang_pred"] in WORDS and out[1]["lang_pred"] == "x"
    assert all(0 <= r["lang_score"] <= 1 for r in out.values())


def test_query_held_out_accuracy_and_folds(spark, docs_of, tables, rows):
    extra = [(None, "the of", "en", "s"), (500, None, "en", None), (501, "the of", None, None), (7, rows[7][1], rows[7][2], "s")]
    sf = tables(documents=docs_of(rows + extra))
    out = op10_langid(spark, sf).collect()
    assert len(out) == len(rows) + 4
    truth = {r[0]: r[2] for r in rows}
    for r in out:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert held and all(r["lang_pred"] == truth[r["doc_id"]] for r in held)


def test_labels_of_held_out_rows_are_never_used(spark, docs_of, tables, rows):
    wrong = [(d, t, "xx" if zlib.crc32(str(d).encode()) % 5 == 0 else la, s) for d, t, la, s in rows]
    got = op10_langid(spark, tables(documents=docs_of(wrong)))
    assert got.where("lang_pred = 'xx'").count() == 0
    unlabelled = docs_of([(1, "abc", None, "s")])
    assert [tuple(r) for r in op10_langid(spark, tables(documents=unlabelled)).collect()][0][2:] == ("und", 0.0)
    assert op10_langid(spark, tables(documents=docs_of([]))).count() == 0


def test_sf_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op10_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.97


def test_a_language_of_copies_is_learned(docs_of):
    """30,000 rows of one text are drawn row by row, not all or none."""
    rows = [(i, "the of and thing with which river", "en", "s") for i in range(3000)]
    rows += [(10_000 + i, "der die und schön über", "de", "s") for i in range(30_000)]
    model = langid.train(docs_of(rows), per_language=50)
    assert model.languages == ["de", "en"] and model.predict("die und über")[0] == "de"
    assert all(model.count[model.lang == k].sum() == 50 * len(t.encode()) for k, t in ((0, rows[-1][1]), (1, rows[0][1])))


def test_forty_languages_keep_order_three(docs_of):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(40):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäöüßéèñ"), 5)) for _ in range(30)]
        rows += [(100 * k + i, " ".join(rng.choice(words, 12)), f"l{k:02d}", "s") for i in range(20)]
    model = langid.train(docs_of(rows))
    assert len(model.languages) == 40
    seen = np.bincount(model.code // 64, model.count) > 1
    for k, (row, _) in enumerate(model.tables()):
        mine = np.unique(model.code[model.lang == k] // 64)
        assert (row[mine[seen[mine]]] >= 64 * 64).all()
    assert sum(model.predict(t)[0] == la for _, t, la, _ in rows[::7]) / len(rows[::7]) > 0.99
