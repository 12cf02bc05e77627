"""Importance resampling: the CRC matrices against zlib, the query against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinio.llm import resample
from tests.llm.fixture import documents, no_documents, rows

TARGET = [("the house over the wind",), (None,), ("",), ("thing and thing straße 12",)]


def brute(docs, target, buckets=10_000, runs=(1, 1), percent=10, least_words=20, seed=2024):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def features(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets for n in range(runs[0], runs[1] + 1)
                for k in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (t_s + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
            for t_s in [sum(s.values())] for b in s}
    out = []
    for i, text in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in features(text))
        out.append((i, len(features(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0))),
                    len(words(text))))
    able = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    drawn = able[:percent * len(able) // 100]
    ranked = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    rest = Counter(r[:4] for r in out) - Counter(r[:4] for r in drawn)
    return sorted(ranked + [(*r, None) for r in rest.elements()], key=str)


def test_crcs_equal_zlib():
    r = random.Random(3)
    sizes = [0, 1, 2, 3, 7, 8, 30, 255, 256, 257, 511, 512, 513, 4000, 70_001]
    data = [bytes(r.choices(range(256), k=r.choice(sizes))) for _ in range(300)] + [b"", b"a", b"the", "ß".encode() * 5000]
    assert resample.crc32s(data).tolist() == [zlib.crc32(d) for d in data]
    assert resample.crc32s([]).tolist() == []


def test_words_are_bytes_of_the_pattern():
    text = "".join(map(chr, range(0x300))) + " A_b-C9 \x7f x y 中文。 \U0001F600z"
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [w.decode() for w in resample.feature_words(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("options", [{}, {"runs": (1, 2), "percent": 50, "least_words": 2, "buckets": 97, "seed": 7},
                                     {"runs": (2, 3), "percent": 100, "least_words": 0}])
def test_rows_equal_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(resample, "REMEMBERED", 50)
    monkeypatch.setattr(resample, "BATCH_CHARS", 400)
    target = spark.createDataFrame(TARGET, "text string")
    got = resample.importance_resample(documents(spark), target, **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == brute([r[:2] for r in rows()], [t for t, in TARGET], **options)


def test_empty_tables(spark):
    target = spark.createDataFrame(TARGET, "text string")
    assert resample.importance_resample(no_documents(spark), target).count() == 0
    got = resample.importance_resample(documents(spark), target.limit(0))
    assert sorted(map(tuple, got.collect()), key=str) == brute([r[:2] for r in rows()], [])


def test_ranks_over_many_ranges_with_ties(spark):
    docs = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    got = resample.importance_resample(docs, spark.createDataFrame([("a",)], "text string"), least_words=1, percent=50)
    drawn = got.where("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in drawn] == list(range(1, 1501))
    assert [(-r["score"], r["doc_id"]) for r in drawn] == sorted((-r["score"], r["doc_id"]) for r in got.collect())[:1500]
