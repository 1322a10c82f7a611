import random

import numpy as np
import pytest

from obligato.llm import toxicity

CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1", "toxic_low_quality": "toxic = 1 AND quality = 0"}


def corpus(n, seed):
    """Prose of random words; toxic texts hold slurs, bad ones junk marks; some labels are wrong."""
    rng, words = random.Random(seed), [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic, bad = rng.random() < 0.2, rng.random() < 0.3
        text = rng.choices(words, k=rng.randint(20, 120))
        text += rng.choices(["grobian", "schuft", "tropf"], k=rng.randint(2, 4)) * toxic + ["qqq", "zzz"] * bad
        rng.shuffle(text)
        rows.append((i, " ".join(text).title(), int(not bad), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(1500, 1)
    noise = random.Random(9)
    labels = [(i, q, 1 - t if noise.random() < 0.03 else t) for i, _, q, t in rows] + [(3, None, 1), (None, 1, 1), (99999, 0, 1)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _, _ in rows], "doc_id long, text string, y0 string")
    return toxicity.fit_chain(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), CATEGORIES)


def test_held_out_accuracy(spark, fitted):
    rows = corpus(600, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, is int")
    got = toxicity.score(df, fitted).collect()
    assert np.mean([r.is_toxic == bool(r["is"]) for r in got]) > 0.98
    assert np.mean([r.is_low_quality == (r.quality == 0) for r in got]) > 0.98
    assert np.mean([r.is_toxic_low_quality == (r["is"] == 1 and r.quality == 0) for r in got]) > 0.95
    clean = toxicity.clean_documents(df, fitted)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in got if not r.is_toxic}


def test_families_of_words_are_told_by_their_beginnings(spark):
    rng, ends = random.Random(3), ["a", "ing", "hr", "wei", "isch", "und", "tum", "en", "ig", "sp", "eu", "or"]
    rows = [(i, " ".join(rng.choices([f"word{k}" for k in range(200)], k=40) + [f"lowei{rng.choice(ends)}"] * (i % 5 == 0)), i % 5 == 0) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean")
    chain = toxicity.fit_chain(df, df.selectExpr("doc_id", "1 AS quality", "int(toxic) AS toxic"), CATEGORIES)
    new = spark.createDataFrame([(1, "word1 loweixyz word2"), (2, "word3 word4")], "doc_id long, text string")
    assert [r.doc_id for r in toxicity.clean_documents(new, chain).collect()] == [2]


def test_chain_feeds_earlier_probabilities(fitted):
    assert [len(m.weights) - len(fitted.signs) for m in fitted.models] == [0, 1, 2]
    assert all(abs(x) > 0.1 for x in fitted.models[2].weights[-2:])
    p = fitted.probabilities([fitted.features(b"Grobian, SCHUFT qqq zzz"), fitted.features(b"")])
    signs = (b"grobian", b"grob~", b"schuft", b"schu~", b"qqq", b"zzz")
    score = fitted.models[2].bias + sum(fitted.models[2].weights[fitted.signs[w]] for w in signs if w in fitted.signs)
    assert p[0, 2] == pytest.approx(1 / (1 + np.exp(-(score + p[0, :2] @ fitted.models[2].weights[-2:]))))


def test_later_models_learn_from_out_of_fold_predictions(monkeypatch):
    seen = []
    fit = toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda x, y: seen.append(x.copy()) or fit(x, y))
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 2, (60, 4)).astype(float), rng.integers(0, 2, (60, 2)).astype(float)
    fold = np.arange(60) % 3
    models = toxicity.fit_models(x, y, fold, ["a", "b"])
    held_out = np.zeros(60)
    for f in range(3):
        w, b = fit(x[fold != f], y[fold != f, 0])
        held_out[fold == f] = toxicity._sigmoid(x[fold == f] @ w + b)
    assert np.allclose(seen[-1][:, -1], held_out)
    assert [m.name for m in models] == ["a", "b"]


def test_null_and_empty_texts_and_tables(spark, fitted):
    rows = [(1, None), (2, ""), (3, "grobian " * 20000), (3, "grobian " * 20000), (None, "x")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, p string")
    got = toxicity.score(df, fitted).collect()
    assert {r.p for r in got} == {"own"}
    assert len(got) == 5 and all(0 <= r.p_toxic <= 1 for r in got)
    assert len({r.p_toxic for r in got if r.doc_id in (1, 2)}) == 1
    assert toxicity.score(df.limit(0), fitted).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    df = spark.createDataFrame([(1, "grobian")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(df, none, CATEGORIES)
    assert toxicity.clean_documents(df, chain).count() == 1
    chain = toxicity.fit_chain(df, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"), CATEGORIES)
    assert toxicity.clean_documents(df, chain).count() == 1
