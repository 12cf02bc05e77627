"""Sharding: the law, gapless slots, groups kept together, awkward rows, a group larger than a shard."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from opinio.llm import shard
from tests.conftest import SF_SMALL
from tests.llm.fixture import documents, no_documents, rows


def check_law(placed, shards):
    counts = Counter(r.shard for r in placed)
    assert set(counts) <= set(range(shards))
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_given_documents(spark, monkeypatch):
    monkeypatch.setattr(shard, "BUCKET_ROWS", 16)
    monkeypatch.setattr(shard, "BUCKETS_AT_ONCE", 4)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    placed = shard.balanced_shards(docs, shards=10).collect()
    check_law(placed, 10)
    texts = {r.doc_id: r.text for r in docs.collect()}
    where = defaultdict(set)
    for r in placed:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        where[texts[r.doc_id]].add(r.shard)
    assert sorted(texts) == sorted(r.doc_id for r in placed)
    several = [t for t, n in Counter(texts.values()).items() if n > 1]
    assert several and sum(len(where[t]) > 1 for t in several) <= 0.1 * len(several)


def test_awkward_rows(spark):
    placed = shard.balanced_shards(documents(spark)).collect()
    check_law(placed, 40)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    assert shard.balanced_shards(no_documents(spark)).count() == 0


def test_a_third_of_all_rows_in_one_group(spark):
    data = [(k, "same" if k % 3 == 0 else f"text {k}") for k in range(1200)]
    placed = shard.balanced_shards(spark.createDataFrame(data, "doc_id long, text string"), shards=8).collect()
    check_law(placed, 8)
    links = Counter(r.shard for r in placed if r.doc_id % 3 == 0)
    at_random = sum((1200 / 8 / 3) ** 2 for _ in range(8))
    assert sum(n * n for n in links.values()) >= at_random  # no more cut links than a random placing


def test_every_text_twice(spark):
    data = [(k, f"text {k // 2}") for k in range(1600)]
    placed = shard.balanced_shards(spark.createDataFrame(data, "doc_id long, text string"), shards=8).collect()
    check_law(placed, 8)
    where = defaultdict(set)
    for r in placed:
        where[r.doc_id // 2].add(r.shard)
    assert sum(len(w) > 1 for w in where.values()) <= 0.1 * len(where)  # nearly all were cut, as no text is without links
