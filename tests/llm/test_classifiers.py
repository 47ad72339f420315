"""Operators 3 and 4: held-out quality, chain inference against enumeration, odd rows."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from errlens.llm import langid, toxicity
from errlens.llm.queries import QUERIES, fold
from tests.llm.conftest import CASES, documents, prose

MEDIUM = "/root/testdata/sf0.01"


def test_window_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    e, t = rng.normal(0, 1, (1, 6, 2)), rng.normal(0, 1, (2, 2))
    paths = np.array(list(product((0, 1), repeat=6)))
    w = np.exp([sum(e[0, k, p[k]] for k in range(6)) + sum(t[p[k], p[k + 1]] for k in range(5)) for p in paths])
    w /= w.sum()
    marginal, pairs = toxicity.chain(e, t)
    assert np.allclose(marginal[0, :, 1], (w[:, None] * paths).sum(0))
    assert np.isclose(pairs[0, 1, 1], sum(x * sum(p[k] * p[k + 1] for k in range(5)) for x, p in zip(w, paths)))


def test_long_stretches_match_the_full_chain():
    model = toxicity.Model({"w:bad": 3.0, "w:odd": -1.0}, bias=-1.3, trans=[[0.0, -0.5], [0.2, 0.7]])
    words = ["a"] * 3 + ["bad"] + ["b"] * 40 + ["odd", "bad"] + ["c"] * 7
    e = np.zeros((1, len(words), 2))
    e[0, :, 1] = [-1.3 + {"bad": 3.0, "odd": -1.0}.get(w, 0.0) for w in words]
    full = toxicity.chain(e, np.array(model.trans))[0][0, :, 1]
    at, p = toxicity.Tagger(model).marginals(words)
    assert at == [3, 44, 45] and np.allclose(p, full[at])


def test_spans_are_offsets_of_the_text():
    tagger = toxicity.Tagger(toxicity.Model({"w:idiot": 9.0, "w:moron": 9.0}, bias=-3.0))
    text = "So, IDIOT moron! İ fine idiot"
    at, p = tagger.marginals(toxicity.words_of(text))
    assert [text[s:e] for s, e, _ in tagger.spans(text, at, p)] == ["IDIOT moron", "idiot"]


def test_toxicity_on_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, MEDIUM).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    held = [(rows[i]["predicted"], y) for i, y in labels.items() if rows[i]["held_out"]]
    assert np.mean([p == y for p, y in held]) > 0.93


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, CASES)
    labels = spark.createDataFrame([(10, 1, "x"), (12, 0, "y"), (99, None, "z"), (None, 1, "w")], "doc_id long, toxic int, y string")
    for train in (F.lit(True), F.col("id") == 12, F.col("id") == 10, F.lit(False)):
        got = toxicity.tag(docs, toxicity.fit(docs, labels, train)).collect()
        assert sorted(repr(r["id"]) for r in got) == sorted(repr(i) for i, _ in CASES)
        assert all(0 <= r["score"] <= 1 for r in got)
    empty = documents(spark, [])
    assert toxicity.tag(empty, toxicity.fit(empty, labels, F.lit(True))).count() == 0


def test_copies_make_no_toxic_words():
    docs = [(prose(1, 60).split() + ["rare"], 1)] * 30 + [(prose(k, 60).split(), 0) for k in range(2, 60)]
    assert not toxicity.lexicon(docs)
    docs += [(prose(k, 60).split() + ["nasty"], 1) for k in range(100, 130)]
    assert "w:nasty" in toxicity.lexicon(docs) and "w:rare" not in toxicity.lexicon(docs)


def test_toxic_words_late_in_long_texts_are_learnt(spark):
    rows = [(k, prose(k, 2500) + " nasty " + prose(k + 500, 20)) for k in range(30)] + [(k, prose(k, 2500)) for k in range(30, 60)]
    assert min(len(t) for _, t in rows) > 10_000
    labels = spark.createDataFrame([(k, int(k < 30)) for k, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, rows), labels, F.lit(True))
    assert model.weights.get("w:nasty", 0) > 1
    assert all((r["score"] >= 0.5) == (r["id"] < 30) for r in toxicity.tag(documents(spark, rows), model).collect())


def test_languages_on_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op4_langid"](spark, MEDIUM).collect()}
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    assert rows.keys() == langs.keys()
    held = [rows[i]["lang_pred"] == v for i, v in langs.items() if rows[i]["held_out"]]
    assert np.mean(held) > 0.97


def test_language_signal_late_in_a_text_is_learnt(spark):
    """Texts alike for their first 12,000 characters."""
    same = prose(9, 2500)
    rows = [(k, same + " " + (" zorg quix blat " if k % 2 else " mell aero sinn ") * 400, "xx" if k % 2 else "yy") for k in range(60)]
    assert len(same) > 10_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs, langid.fit(docs, F.col("id") < 40)).collect()
    assert all(r["lang_pred"] == ("xx" if r["id"] % 2 else "yy") for r in got)


def test_many_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "TOTAL", 20)
    monkeypatch.setattr(langid, "SAMPLE", 3)
    seen = []
    monkeypatch.setattr(langid, "train", lambda grams, y, langs: seen.append((len(grams), len(langs))) or langid.Model())
    docs = spark.createDataFrame([(k, prose(k, 20), f"l{k % 10}") for k in range(200)], "doc_id long, text string, lang string")
    langid.fit(docs, F.lit(True))
    assert seen == [(20, 10)]


def test_windows_reach_the_whole_text():
    words = ["bad" if k % 10 == 0 else "x" for k in range(5000)]
    model = {"w:bad": 0}
    places = set()
    for seed in range(40):
        got = toxicity.windows_of(words, model, seed)
        assert len(got) == toxicity.HITS + 2
        places.add(tuple(map(len, map(str, got))))
    text = ["x"] * 4000 + ["bad"]
    assert any(any(w) for w in toxicity.windows_of(["bad", *text], model, 1))


def test_languages_of_odd_rows(spark):
    docs = documents(spark, [*CASES, (40, "123 ½ ²"), (41, "_")])
    train = spark.createDataFrame([(k, t, v) for k, (t, v) in enumerate([("the of and", "en"), ("le la les", "fr"), (None, "en"), ("x", None)] * 3)],
                                  "doc_id long, text string, lang string")
    got = {repr(r["id"]): r for r in langid.identify(docs, langid.fit(train, F.lit(True))).collect()}
    assert got["1"]["lang_pred"] == got["2"]["lang_pred"] == got["3"]["lang_pred"] == got["40"]["lang_pred"] == got["41"]["lang_pred"] == "und"
    assert got["4"]["lang_pred"] in ("en", "fr") and 0 <= got["4"]["score"] <= 1 and got["1"]["score"] == 0
    none = langid.identify(docs, langid.fit(train, F.lit(False))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert langid.identify(documents(spark, []), langid.Model()).count() == 0


@pytest.mark.parametrize("n", [1, 3, 1000])
def test_folded_table_equals_the_mean_of_embeddings(n):
    rng = np.random.default_rng(n)
    model = langid.Model(["a", "b"], rng.normal(0, 1, (langid.BUCKETS, 2)), np.zeros(2))
    texts = ["x", "", "Hello  World", prose(n, n), "é", ""]
    for t, p in zip(texts, langid.score(model, texts)):
        z = model.table[langid.grams_of(t.encode())].mean(0) if t else np.zeros(2)
        assert np.allclose(p, langid.softmax(z[None])[0])
        assert np.allclose(p, langid.score(model, [t])[0])          # its neighbours don't matter


def test_fold_is_the_checksum_rule(spark):
    import zlib
    rows = spark.range(50).select("id", fold("id").alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)
