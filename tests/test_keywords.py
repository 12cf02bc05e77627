"""Keyword clusters: planted groups, links by hand, awkward texts."""

from __future__ import annotations

import random
from collections import Counter
from math import log

from opinio.operators import keywords

SCHEMA = "text string"


def test_planted_clusters_are_found(spark):
    r = random.Random(6)
    groups = [[f"{g}{c}" for c in "abcdef"] for g in ("sea", "war", "tax")]
    texts = []
    for _ in range(60):
        g = r.choice(groups)
        texts.append(" ".join(r.choice(g) for _ in range(40)))
    got = {x.term: x for x in keywords.keyword_clusters(spark.createDataFrame([(t,) for t in texts], SCHEMA), "text").collect()}
    assert set(got) == {t for g in groups for t in g}
    for term, row in got.items():
        assert row.cluster[:3] == term[:3] == row.neighbour[:3] and row.weight > 0
    assert Counter(x.cluster for x in got.values()) == {x.cluster: x.size for x in got.values()}


def test_links_and_weights_by_hand(spark):
    texts = ["red car"] * 4 + ["red rose"] * 3 + ["car"] * 3 + ["alone"] * 3 + ["twice twice"] * 2 + ["rare red"]
    got = {x.term: tuple(x)[1:] for x in keywords.keyword_clusters(spark.createDataFrame([(t,) for t in texts], SCHEMA), "text").collect()}
    total = 8 + 6 + 3 + 3 + 4 + 2
    rose, car = round(log(3 * total / (8 * 3)), 6), round(log(4 * total / (8 * 7)), 6)
    assert got == {"red": (8, "red", 3, "rose", rose), "rose": (3, "red", 3, "red", rose), "car": (7, "red", 3, "red", car),
                   "alone": (3, "alone", 1, None, None), "twice": (4, "twice", 1, None, None)}


def test_a_long_chain_ends_in_its_strongest_pair(spark):
    # Link k of the chain is seen together 3 + k times and its terms are padded to one count: lifts rise along the chain.
    n, texts = 20, []
    for k in range(n):
        texts += [f"{chr(97 + k)}q {chr(98 + k)}q"] * (3 + k)
    seen = Counter(w for t in texts for w in t.split())
    texts += [w for w, c in seen.items() for _ in range(60 - c)]
    got = {x.term: x for x in keywords.keyword_clusters(spark.createDataFrame([(t,) for t in texts], SCHEMA), "text").collect()}
    last = chr(96 + n) + "q"
    assert {x.cluster for x in got.values()} == {last} and len(got) == n + 1 == got[last].size


def test_awkward_texts(spark):
    rows = [(None,), ("",), (" 12 !",), ("one",), ("A a A a",)]
    got = keywords.keyword_clusters(spark.createDataFrame(rows, SCHEMA), "text").collect()
    assert [tuple(r) for r in got] == [("a", 4, "a", 1, None, None)]
    assert keywords.keyword_clusters(spark.createDataFrame([], SCHEMA), "text").count() == 0
