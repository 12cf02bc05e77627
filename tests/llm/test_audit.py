"""Filter audit: path counts against all orders, rows against applying the filters in every order."""

from __future__ import annotations

import itertools
import re
from collections import Counter
from math import factorial

from opinio.llm import audit
from tests.llm.fixture import SCHEMA, documents, no_documents, rows

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, 1, 1), (12, None, 1), (None, 1, 1), (13, 1, 0), (999, 1, 1)]
LABEL_SCHEMA = "doc_id long, quality int, toxic int"


def failing(docs):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        yield i, lang or "", {k for k, v in bad.items() if v}


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    found, shapley = {}, Counter()
    table = list(failing(docs))
    for part in {p for _, p, _ in table}:
        for order in itertools.permutations("ABCDE"):
            left = [(i, bad) for i, p, bad in table if p == part]
            everyone = list(left)
            for step, f in enumerate(order, 1):
                gone = [(i, bad) for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                shapley[part, f] += len(gone)
                found[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in bad for _, bad in everyone) - len(gone), sum(bad == {f} for _, bad in everyone),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items())


def test_paths_are_counted_from_both_ends():
    for k in (1, 3, 5):
        lattice = audit.Lattice(k)
        assert lattice.forward[lattice.full] == lattice.backward[0] == factorial(k)
        through = Counter()
        for order in itertools.permutations(range(k)):
            state = 0
            for f in order:
                through[state, f] += 1
                state |= 1 << f
        assert {(s, f): lattice.through(s, f) for s, f in lattice.edges()} == dict(through)


def test_rows_equal_every_order_applied(spark):
    extra = [(30, "LOUD WORDS # HERE", "en"), (31, "LOUD WORDS # HERE", "de"), (None, "LOUD WORDS # HERE", "en"), (31, "LOUD WORDS # HERE", "de"),
             (32, "x " * 200, "en"), (33, " ".join(f"w{k}" for k in range(150)), "en"), (34, " ".join(f"w{k}" for k in range(150)), "en")]
    docs = [r[:3] for r in rows()] + extra
    table = documents(spark).unionByName(spark.createDataFrame([(*r, None, None, "", "", 1, 2, "", 3, 4, 5) for r in extra], SCHEMA))
    got = audit.filter_audit(table, spark.createDataFrame([(*r, "clash") for r in LABELS], LABEL_SCHEMA + ", lang string"))
    assert sorted(map(tuple, got.collect())) == brute(docs, LABELS)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABEL_SCHEMA)
    assert audit.filter_audit(no_documents(spark), labels).count() == 0
    got = audit.filter_audit(documents(spark), labels)
    assert sorted(map(tuple, got.collect())) == brute([r[:3] for r in rows()], [])
