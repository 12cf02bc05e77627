"""Masked pseudo-likelihood: counts, classes and sums by brute force, order and copies matter, awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import exp, log

import numpy as np

from opinio.llm import scoring
from tests.llm.fixture import documents, no_documents, rows


def lower_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def hash_of(word):
    return int(scoring.hashed([word.decode()])[0][0])


def learned(docs, rounds=scoring.ROUNDS):
    docs = docs.select("doc_id", "text")
    known = scoring.vocabulary(scoring.count_words(docs))
    coded = scoring.code(docs, known)
    classes = scoring.word_classes(coded, known)
    return known, classes, coded, scoring.train(coded, classes, rounds)


def brute_score(text, known, classes, net, counts):
    """Sum of the conditionals of one text, word by word; counts are those of the whole corpus."""
    words = lower_words(text)
    place = [int(scoring.Vocabulary.places(known, np.array([hash_of(w)]))[0]) for w in words]
    cls = [int(classes.of_place[p]) for p in place]
    members = Counter()
    for w, n in counts.items():
        members[int(classes.of_place[int(known.places(np.array([hash_of(w)]))[0])])] += n
    total = 0.0
    for k, w in enumerate(words):
        near = [*range(k - scoring.SIDE, k), *range(k + 1, k + scoring.SIDE + 1)]
        h = [float(v) for v in net.bias]
        for j, at in enumerate(near):
            c = cls[at] if 0 <= at < len(cls) else scoring.EDGE
            h = [a + float(e) for a, e in zip(h, net.embed[j][c])]
        p = [exp(v) for v in np.tanh(h) @ net.row.astype(float) + net.row_bias]
        r, m = divmod(cls[k], scoring.ROW)
        q = [exp(v) for v in np.tanh(h) @ net.member[r].astype(float) + net.member_bias[r]]
        total += log(p[r] / sum(p) * q[m] / sum(q)) + log(counts[w] / members[cls[k]])
    return len(words), total


def test_counts_and_vocabulary(spark):
    docs = documents(spark).select("doc_id", "text")
    want = Counter(w for _, t, *_ in rows() for w in lower_words(t))
    counts = scoring.count_words(docs)
    assert {r.word: r.n for r in counts.collect()} == {hash_of(w): n for w, n in want.items()}
    for most in (scoring.VOCABULARY, 20, 0):
        known = scoring.vocabulary(counts, most)
        inside = {hash_of(w): n for w, n in want.items() if n >= max(scoring.LEAST, known.least)}
        assert dict(zip(known.words.tolist(), known.n.tolist())) == inside and len(inside) <= most
        assert known.rare == sum(want.values()) - sum(inside.values())


def test_scores_are_the_sum_of_conditionals(spark):
    docs = documents(spark)
    known, classes, coded, net = learned(docs)
    counts = Counter(w for _, t, *_ in rows() for w in lower_words(t))
    texts = [t for _, t, *_ in rows() if t is None or len(t) < 2000]
    words, n = scoring.hashed(texts)
    got = scoring.score_places(known.places(words), n, net, classes)
    rare = np.array([log(counts[w]) if known.places(np.array([hash_of(w)]))[0] == len(known.words) else 0
                     for t in texts for w in lower_words(t)])
    got += [part.sum() for part in np.split(rare, np.cumsum(n)[:-1])]
    for text, size, log_p in zip(texts, n, got):
        want = brute_score(text, known, classes, net, counts)
        assert size == want[0] and abs(log_p - want[1]) < 1e-3 * max(1, size)
    whole = scoring.score(docs).where("n_words > 0 and n_words < 300").collect()
    assert whole and {r.n_words for r in whole} <= {len(lower_words(t)) for _, t, *_ in rows()}


def test_classes_follow_the_commonest_neighbour(spark):
    r = random.Random(1)
    frequent = [f"f{k}" for k in range(scoring.OWN)]
    nouns, verbs = [f"n{k}" for k in range(30)], [f"v{k}" for k in range(30)]
    texts = [" ".join(frequent * 6 + [w for _ in range(40) for w in ("f0", r.choice(nouns), "f1", r.choice(verbs))]) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    known, classes, _, _ = learned(docs, 0)
    cls = {w: int(classes.of_place[known.places(np.array([hash_of(w.encode())]))[0]]) for w in frequent + nouns + verbs}
    assert sorted(cls[w] for w in frequent) == list(range(scoring.OWN))
    # A noun stands behind f0 and before f1, a verb behind f1 and before f0: whichever side counts, they differ.
    assert not {cls[w] for w in nouns} & {cls[w] for w in verbs}
    assert {cls[w] for w in nouns + verbs} <= set(range(scoring.OWN, scoring.RARE))
    share = np.bincount(classes.of_place[:-1], weights=np.exp(classes.log_p[:-1].astype(float)))
    assert np.allclose(share[share > 0], 1, atol=1e-4)


def test_a_trained_network_knows_order(spark):
    r = random.Random(0)
    cycle = [f"w{k}" for k in range(40)]

    def prose(n):
        k = r.randrange(40)
        return " ".join(cycle[(k + j) % 40] for j in range(n))

    docs = spark.createDataFrame([(k, prose(600)) for k in range(120)], "doc_id long, text string").repartition(2)
    known, classes, _, net = learned(docs, 12)
    right = [prose(100) for _ in range(30)]  # not trained on
    wrong = [" ".join(r.sample(t.split(), 100)) for t in right]

    def total(texts):
        words, n = scoring.hashed(texts)
        return scoring.score_places(known.places(words), n, net, classes)

    assert (total(right) > total(wrong)).all()
    unigram = 100 * log(1 / 40)
    assert (total(right) > unigram).all()


def test_texts_that_occur_twice_score_higher(spark):
    r = random.Random(3)
    texts = [" ".join(f"{r.choice('abcdef')}{r.randrange(10 ** 6)}" for _ in range(50)) for _ in range(40)]
    twice = set(range(0, 40, 4))
    docs = [(k, t) for k, t in enumerate(texts)] + [(k + 100, texts[k]) for k in twice]
    got = {x.doc_id: x.mean_log_p for x in scoring.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert min(got[k] for k in twice) > max(v for k, v in got.items() if k < 100 and k not in twice)


def test_awkward_rows(spark):
    got = scoring.score(documents(spark)).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_words == 0) == (r.mean_log_p is None) and r.log_p <= 0
        if r.n_words == 0:
            assert r.log_p == 0
        else:
            assert abs(r.mean_log_p - r.log_p / r.n_words) < 1e-9
    equal = {r.log_p for r in got if r.doc_id in (1, 3, 5)}
    assert len(equal) <= 3 and max(equal) - min(equal) < 1e-3
    assert scoring.score(no_documents(spark)).count() == 0


def test_every_position_trains_in_every_round(spark):
    # In a text of 16 words that come again and again, each 16th position is always the same word.
    cycle = [f"w{k}" for k in range(16)]
    docs = spark.createDataFrame([(k, " ".join(cycle * 40)) for k in range(20)], "doc_id long, text string").repartition(2)
    known, classes, coded, net = learned(docs, 12)
    shared, flat = spark.sparkContext.broadcast(classes.of_place), spark.sparkContext.broadcast(scoring.start().flat())
    local = coded.select("n_words", "places").mapInPandas(scoring._train(flat, shared), "seen long, weights array<float>")
    assert sum(r.seen for r in local.collect()) == 20 * 16 * 40
    cls = classes.of_place[known.places(scoring.hashed([" ".join(cycle * 3)])[0])]
    p = scoring.log_probs(net, scoring.contexts(cls, np.array([48])), cls)[16:32]
    assert len(set(cls)) == 16 and (p > np.log(1 / 16)).all()


def test_the_classes_of_words_fill_their_rows():
    assert scoring.EDGE == scoring.ROW ** 2
    r = np.random.default_rng(2)
    net = scoring.Network.of(r.normal(0, 1, len(scoring.start().flat())))
    around = np.repeat(r.integers(0, scoring.CLASSES, (5, 2 * scoring.SIDE)), scoring.EDGE, axis=0)
    p = np.exp(scoring.log_probs(net, around, np.tile(np.arange(scoring.EDGE), 5)))
    assert np.allclose(p.reshape(5, -1).sum(axis=1), 1, atol=1e-5)


def test_steps_follow_the_slope_of_the_loss():
    r = np.random.default_rng(4)
    flat = r.normal(0, 0.3, len(scoring.start().flat()))
    around, target = r.integers(0, 6, (64, 2 * scoring.SIDE)), r.integers(0, scoring.EDGE, 64)

    def loss(weights):
        return -scoring.log_probs(scoring.Network.of(weights), around, target).mean()

    squares = [np.full(s, 1e-30, np.float32) for s in scoring.Network.shapes()]
    scoring.train_steps(scoring.Network.of(flat), squares, around, target, np.arange(64))
    slope = np.sqrt(np.concatenate([s.ravel() for s in squares]))
    for k in r.choice(np.flatnonzero(slope > 1e-3), 40, replace=False):
        near = flat.copy(), flat.copy()
        near[0][k] += 1e-2
        near[1][k] -= 1e-2
        assert abs(abs(loss(near[0]) - loss(near[1])) / 2e-2 - slope[k]) < 2e-3 + 0.02 * slope[k]
