"""Mixing: brute force, even schedule, awkward rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import mix
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.fixture import documents, no_documents, rows


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "text")
    want, _ = brute.mix([tuple(r) for r in docs.collect()])
    mixed = mix.mix(docs)
    got = {r.doc_id: r for r in mixed.documents.collect()}
    assert len(got) == len(want)
    for i, size, source_size, target, taken in want:
        r = got[i]
        assert (r.size, r.source_size, r.taken) == (size, source_size, taken)
        assert r.target == pytest.approx(target, rel=1e-12) and r.taken <= 3 * r.size
    # Every stretch of the schedule holds each source within a few slots of its share.
    shares = {r.number: r.target for r in mixed.sources.collect()}
    total = sum(shares.values())
    order = [r.number for r in mixed.schedule.orderBy("slot").collect()]
    for a, b in ((0, 500), (1000, 4000), (0, len(order))):
        seen = Counter(order[a:b])
        assert all(abs(seen[s] - (b - a) * t / total) <= 12 for s, t in shares.items())
    by_source = Counter()
    for r in got.values():
        by_source[r.target] += r.taken
    targets = Counter(shares.values())
    for target, taken in by_source.items():
        assert abs(taken - targets[target] * target) <= 0.03 * targets[target] * target + 12 * mixed.block_words


def test_awkward_rows_and_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(mix, "BUCKET_ROWS", 4)
    monkeypatch.setattr(mix, "RANGE_SLOTS", 100)
    docs = documents(spark)
    got = mix.mix(docs).documents.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows())
    sizes = Counter()
    for _, text, _, source, *_ in rows():
        sizes[source] += brute.n_words(text)
    want = brute.targets(dict(sizes))
    assert sorted({(r.source_size, round(r.target, 6)) for r in got}) == sorted({(sizes[s], round(t, 6)) for s, t in want.items()})
    assert all(r.taken <= 3 * r.size for r in got) and sum(r.taken for r in got) > 0
    taken = Counter()
    for r in got:
        taken[r.source_size] += r.taken
    due = Counter()
    for s, t in want.items():
        due[sizes[s]] += t
    for size, t in due.items():
        assert abs(taken[size] - t) <= 0.03 * t + 20
    again = mix.mix(docs.repartition(5)).documents.collect()
    assert sorted((str(r.doc_id), r.taken) for r in again) == sorted((str(r.doc_id), r.taken) for r in got)
    whole = mix.mixed_documents(docs)
    assert whole.columns == docs.columns
    copies = Counter(r.doc_id for r in whole.collect())
    assert set(copies) <= {i for i, t, *_ in rows() if t and t.strip()} and max(copies.values()) <= 6
    assert mix.mix(no_documents(spark)).documents.count() == 0


def test_points_stay_even_over_millions_of_slots(spark):
    """A source with a few slots among four million: every stretch of its mean distance holds about one."""
    total, n = 1 << 32, 1 << 22
    sources = spark.createDataFrame([(0, 0.0, total * 0.6), (1, total * 0.6, total * (0.6 + 5 / n)), (2, total * (0.6 + 5 / n), 2.0 * total)],
                                    "number int, low double, high double")
    got = mix._schedule(sources, n, total)
    counts = {r["number"]: r["n"] for r in got.groupBy("number").agg(F.count("*").alias("n")).collect()}
    assert abs(counts[0] - 0.6 * n) <= 12 and 2 <= counts[1] <= 8 and sum(counts.values()) == n
    # wherever such an interval lies, it is neither empty nor crowded
    step = sum(limb << 24 * k for k, limb in enumerate(mix._STEP))
    assert abs(step / 2**72 - (5**0.5 - 1) / 2) < 1e-15
    x = np.sort(np.cumsum(np.full(n, step >> 8, dtype=np.uint64), dtype=np.uint64))
    gaps = np.diff(x).astype(float) / 2**64 * n
    assert gaps.max() < 2


def test_a_small_source_is_taken_near_its_target(spark):
    docs = spark.range(0, 3000).select("id", F.when(F.col("id") < 3, "a").otherwise("b").alias("source"), F.concat(
        F.lit("word "), F.col("id")).alias("text")).withColumnRenamed("id", "doc_id")
    got = mix.mix(docs).documents.groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.1 * r["target"] + 2 for r in got) and min(r["target"] for r in got) == 18


def test_reruns_agree_whatever_the_order_of_rows(spark):
    table = [(None, f"text {k} " * (k + 1)) for k in range(8)] + [(3, "a b c"), (3, "a b c d"), (3, "a b c"), (None, None)]
    results = []
    for rows_ in (table, table[::-1], table[5:] + table[:5]):
        docs = spark.createDataFrame([(i, "s", t) for i, t in rows_], "doc_id long, source string, text string").coalesce(1)
        found = mix.mix(docs, block_words=1).documents.collect()
        results.append(sorted((str(r.doc_id), str(r.text_key), r.taken) for r in found))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(table)
