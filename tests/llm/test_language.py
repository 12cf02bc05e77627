"""Language ID: held-out accuracy, defined results on awkward rows, pieces add up."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np

from opinio.llm import langid
from tests.conftest import SF_SMALL
from tests.llm.fixture import documents, no_documents, rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 200
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang_pred == r.lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_awkward_rows(spark):
    got = langid.identify(documents(spark)).collect()
    assert len(got) == len(rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for doc_id in (6, 7, 10, 11):  # empty, NULL, white space, no letter
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[12].lang_pred == by_id[13].lang_pred == "de" and by_id[1].lang_pred == "en"
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert langid.identify(no_documents(spark)).count() == 0
    kept = langid.keep_identified(documents(spark))
    assert kept.columns == documents(spark).columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 5, 12, 13, 18}
    assert not {6, 7, 10, 11} & {r.doc_id for r in kept.collect()}


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.identify(docs).collect()] == [(1, False, "und", 0.0)]


def test_a_long_text_scores_like_its_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    log_p = rng.normal(size=(langid.BUCKETS, 2))
    model = langid.LanguageModel(["a", "b"], log_p, np.zeros(2))
    texts = ["".join(rng.choice(list("abc dé"), 20)) for _ in range(50)] + [None, "", "\U0001d49c\U00020000x"]
    whole = langid.score_texts(texts, model)
    monkeypatch.setattr(langid, "PIECE", 7)
    cut = langid.score_texts(texts, model)
    assert (whole["lang_pred"] == cut["lang_pred"]).all() and np.allclose(whole["score"], cut["score"])


def brute_grams(text):
    """Bucket of every 1- to 3-gram, one at a time: the operator's hash in plain integers."""
    codes = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32 for c in text]
    out = Counter()
    for n in (1, 2, 3):
        for k in range(len(codes) - n + 1):
            h = n
            for c in codes[k:k + n]:
                h = (h ^ c) * 0x9E3779B97F4A7C15 % (1 << 64)
                h ^= h >> 29
            out[(h >> 20) % langid.BUCKETS] += 1
    return out


def test_counts_and_posteriors_against_brute_force(spark):
    table = [(i, t, g) for i, t, g, *_ in rows() if i != 13] + [(30 + k, f"{w} straße ist {k} lang", "de") for k, w in enumerate("abcdefgh")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3)
    counts, n_docs = {}, Counter()
    for doc_id, text, lang in table:
        if doc_id is not None and text is not None and lang is not None and zlib.crc32(str(doc_id).encode()) % 5:
            counts.setdefault(lang, Counter()).update(brute_grams(text))
            n_docs[lang] += 1
    model = langid.learn(docs)
    assert model.languages == sorted(counts) and len(counts) == 2
    for k, lang in enumerate(model.languages):
        total = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
        want = [math.log((counts[lang][b] + 0.5) / total) for b in range(langid.BUCKETS)]
        assert np.allclose(model.log_p[:, k], want, rtol=1e-12)
    # Scores: the sum of each text's own n-grams, by the rule of Bayes.
    for (_, text, _), pred, score in zip(table, *langid.score_texts([t for _, t, _ in table], model).to_numpy().T):
        if not any(c.isalpha() for c in text or ""):
            assert (pred, score) == ("und", 0.0)
            continue
        points = [model.log_prior[k] + sum(n * model.log_p[b, k] for b, n in brute_grams(text).items()) for k in range(2)]
        best = int(np.argmax(points))
        assert pred == model.languages[best] and abs(score - 1 / sum(math.exp(p - points[best]) for p in points)) < 1e-9
    share = [n_docs[lang] / sum(n_docs.values()) for lang in model.languages]
    assert np.allclose(model.log_prior, np.log(share), rtol=1e-12)
