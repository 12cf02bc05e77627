"""Exact dedup, MinHash near-dedup and repeated byte strings against brute force."""

from __future__ import annotations

import hashlib
import struct
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import zstandard

from opinio.llm import exact, minhash, shingles, suffix
from opinio.llm.components import components
from tests.llm.fixture import documents, no_documents, rows


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def test_normalise():
    for text, want in [(None, b""), ("", b""), (" ", b" "), ("\n\t a\x0bb ", b" a b "), ("a b", "a b".encode()),
                       ("a  b", b"a b"), ("\x1fa", b"\x1fa")]:
        assert exact.normalise(text) == want
        assert want == re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())


@pytest.mark.parametrize("block_bytes", [7, 8192])
def test_exact_dedup(spark, block_bytes):
    got = [tuple(r) for r in exact.exact_dedup(documents(spark), block_bytes).collect()]
    groups = defaultdict(list)
    for doc_id, text, *_ in rows():
        groups[exact.normalise(text)].append(doc_id)
    want = Counter()
    for text, ids in groups.items():
        ids.sort(key=order)
        for k, i in enumerate(ids):
            want[(i, ids[0], len(ids), k == 0, hashlib.sha256(text).hexdigest())] += 1
    assert Counter(got) == want
    assert exact.exact_dedup(no_documents(spark), block_bytes).count() == 0


def test_drop_exact_copies_keeps_all_columns(spark):
    docs = documents(spark)
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    got = Counter(exact.normalise(r.text) for r in kept.collect())
    assert got == Counter({exact.normalise(t) for _, t, *_ in rows()})


def brute_sets():
    out = []
    for doc_id, text, *_ in rows():
        ws = shingle_words(text)
        out.append((doc_id, {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()))
    return out


def shingle_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).encode())


def test_shingle_sets_whole_and_in_parts(monkeypatch):
    texts = [t for _, t, *_ in rows()]
    whole = shingles.shingle_sets(texts)
    assert [len(s) for s in whole] == [len(s) for _, s in brute_sets()]
    monkeypatch.setattr(shingles, "PART_BYTES", 50)
    assert all((a == b).all() for a, b in zip(whole, shingles.shingle_sets(texts)))


def components_of(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                root[find(a)] = find(b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("block", [512, 2])
def test_minhash(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    sets = brute_sets()

    def linked(a, b):
        x, y = sets[a][1], sets[b][1]
        return bool(x) and 100 * len(x & y) >= 80 * len(x | y)

    comp = components_of(len(sets), linked)
    groups = defaultdict(list)
    for k, c in enumerate(comp):
        groups[c].append(sets[k][0])
    want = Counter()
    for ids in groups.values():
        ids.sort(key=order)
        for k, i in enumerate(ids):
            want[(i, ids[0], k == 0)] += 1
    got = minhash.near_duplicates(documents(spark), 80).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == want
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(s)) for i, s in sets)
    if block == 512:
        assert minhash.near_duplicates(no_documents(spark), 80).count() == 0
        kept = minhash.drop_near_copies(documents(spark))
        assert kept.columns == documents(spark).columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, k in want.elements() if k)


def test_posterior_bounds_are_safe():
    for n, least in minhash.least_matches(0.85):
        # One match less than the bound is rarer than MISS for a pair at the threshold.
        from math import comb
        assert sum(comb(n + 1, m) * 0.85**m * 0.15**(n + 1 - m) for m in range(least)) < minhash.MISS
        assert 0 < least < n


def test_components_of_long_paths_and_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_longest_previous_factors_of_random_binary_strings(seed):
    rng = np.random.default_rng(seed)
    parts = [bytes(rng.integers(0, 2, rng.integers(1, 40), dtype=np.uint8)) for _ in range(30)]
    parts += [parts[0], b"\0" * 50, b"\0" * 33]
    data, sizes = b"".join(parts), np.array([len(p) for p in parts])
    ends = np.repeat(np.cumsum(sizes), sizes)
    # All positions, then all but the last byte of each part.
    for starts in (np.arange(len(data)), np.flatnonzero(np.arange(len(data)) < ends - 1)):
        got = suffix.longest_previous_factors(np.frombuffer(data, np.uint8), ends, starts)
        rest = {i: data[i:ends[i]] for i in starts}
        shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert got.tolist() == [max((shared(rest[i], rest[j]) for j in starts if j < i), default=0) for i in starts]
    none = np.zeros(0, np.int64)
    assert len(suffix.longest_previous_factors(np.zeros(0, np.uint8), none, none)) == 0


def place(doc_id, data):
    """Order of documents: by id, NULL ids behind them, equal ids by digest."""
    halves = struct.unpack("<qQ", hashlib.md5(data).digest())
    return (1, halves[1] >> 2, halves[0]) if doc_id is None else (0, doc_id, halves[0])


def brute_repeats(length):
    table = sorted(((order(i), place(i, (t or "").encode()), i, (t or "").encode()) for i, t, *_ in rows()),
                   key=lambda x: x[1])
    seen, out, before = set(), Counter(), None
    for _, key, doc_id, data in table:
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - length + 1):
            if data[k:k + length] in seen:
                gone[k:k + length] = True
            seen.add(data[k:k + length])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(data) else 0
        out[(doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept)] += 1
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_strings(spark, monkeypatch, hot):
    if hot:  # every anchor hash is spread window by window; pieces cut the long text
        monkeypatch.setattr(suffix, "HOT", 1)
        monkeypatch.setattr(suffix, "LOCAL_HOT", 1)
        monkeypatch.setattr(suffix, "PIECE", 1000)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
                  for r in suffix.remove_repeats(documents(spark)).collect())
    assert got == brute_repeats(suffix.LENGTH)
    if not hot:
        assert suffix.remove_repeats(no_documents(spark)).count() == 0


def test_texts_of_one_id_with_like_digests_stay(spark):
    """Two texts of one id whose digests share their first bytes have nothing in common; neither loses a byte."""
    by_start, pair, k = {}, None, 0
    while pair is None:
        text = "".join(f"{hashlib.sha256(f'{k}:{j}'.encode()).hexdigest()[:11]} " for j in range(15))
        start, k = hashlib.md5(text.encode()).digest()[:2], k + 1
        if start in by_start:
            pair = by_start[start], text
        by_start[start] = text
    docs = spark.createDataFrame([(7, pair[0]), (7, pair[1]), (7, pair[1]), (None, pair[0] + "x" * 99)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_removed, bytes(r.kept).decode()) for r in suffix.remove_repeats(docs).collect())
    n = len(pair[0])
    assert got == sorted([(False, 0, pair[0]), (False, 0, pair[1]), (False, n, ""), (True, n, "x" * 99)])


def test_repeated_windows_against_brute_force():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 400).astype(np.uint8)
    length = 6
    starts = np.arange(len(data) - length + 1)
    got = suffix.longest_previous_factors(data, np.full(len(data), len(data)), starts) >= length
    strings = [data[k:k + length].tobytes() for k in starts]
    assert got.tolist() == [s in strings[:k] for k, s in enumerate(strings)]
    ends = np.full(len(data), len(data))
    order = suffix.suffix_order(suffix.suffix_levels(data, ends), ends, starts)
    assert order.tolist() == sorted(starts.tolist(), key=lambda k: data[k:].tobytes())


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("partitions", [1, 4])
def test_the_first_of_repeated_rows_keeps_its_text(spark, monkeypatch, hot, partitions):
    if hot:
        monkeypatch.setattr(suffix, "LOCAL_HOT", 1)
    r = np.random.default_rng(5)
    text = [" ".join(f"w{x}" for x in r.integers(0, 10**6, 60)) for _ in range(4)]
    shared = " ".join(f"s{x}" for x in r.integers(0, 10**6, 30))
    table = [(1, text[0])] * 2 + [(None, text[1])] * 3 + [(2, text[2] + shared)] * 2 + [(3, shared + text[3])] * 2
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(partitions)
    got = Counter((r.doc_id, bytes(r.kept)) for r in suffix.remove_repeats(docs).collect())
    # NULL ids come last and document 2 before 3, so only 3 loses the shared words in its first row.
    want = Counter({(1, text[0].encode()): 1, (1, b""): 1, (None, text[1].encode()): 1, (None, b""): 2,
                    (2, (text[2] + shared).encode()): 1, (2, b""): 1, (3, text[3].encode()): 1, (3, b""): 1})
    assert got == want


def hot_documents(n):
    """Every document has one passage between texts of its own."""
    r = np.random.default_rng(6)
    passage = " ".join(f"p{x}" for x in r.integers(0, 10**6, 25))
    return passage, [(k, f"{r.integers(0, 10**9)} only here {k} " + passage + f" {k} and {r.integers(0, 10**9)}") for k in range(n)]


def test_windows_of_a_hot_passage_travel_once_a_task(monkeypatch):
    passage, table = hot_documents(300)
    zip_, spans = zstandard.ZstdCompressor(), []
    for _, text in table:
        spans.append(np.array([[0, len(text) - suffix.LENGTH + 1, 1]], np.int32).tobytes())
    pdf = pd.DataFrame({"key": range(300), "twin": 0, "spans": spans, "anchors": [np.zeros(1, np.int64).tobytes()] * 300,
                        "z": [zip_.compress(t.encode()) for _, t in table]})
    sent = pd.concat(suffix._fetch(5)(iter([pdf])))
    packs = [p for p in sent["pack"] if p is not None]
    distinct = {t[k:k + suffix.LENGTH] for _, t in table for k in range(len(t) - suffix.LENGTH + 1)}
    assert len(suffix._unpack(packs, suffix._WINDOW_FIELDS)["key"]) == len(distinct)
    decided = sent[sent["spans"].notna()]
    assert sorted(decided["key"]) == list(range(1, 300)) and all(len(s) == 12 for s in decided["spans"])


@pytest.mark.parametrize("gather", [1 << 20, 500])
def test_a_hot_passage_stays_in_its_first_document(spark, monkeypatch, gather):
    monkeypatch.setattr(suffix, "LOCAL_HOT", 8)
    monkeypatch.setattr(suffix, "GATHER_WINDOWS", gather)
    monkeypatch.setattr(suffix, "TASK_WINDOWS", 2000)
    passage, table = hot_documents(300)
    seen, want = set(), {}
    for k, text in table:
        gone = np.zeros(len(text), dtype=bool)
        for a in range(len(text) - suffix.LENGTH + 1):
            gone[a:a + suffix.LENGTH] |= text[a:a + suffix.LENGTH] in seen
            seen.add(text[a:a + suffix.LENGTH])
        want[k] = np.frombuffer(text.encode(), np.uint8)[~gone].tobytes()
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    assert {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(docs).collect()} == want
    assert passage.encode() in want[0] and not any(passage.encode() in want[k] for k in range(1, 300))
