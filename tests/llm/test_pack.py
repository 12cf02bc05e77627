"""Packing: the rule against its definition, pieces against the tokenizers library, places against the bound."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opinio.llm import bpe, pack
from tests.llm.fixture import documents, no_documents, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


def wanted_pieces(capacity):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    for doc_id, text, *_ in rows():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            piece = ids[at:at + capacity]
            yield doc_id, k, at, len(piece), zlib.crc32(piece.tobytes())


def check_places(placed, capacity):
    """Every sequence is filled from 0 without gaps or overlaps."""
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pieces_and_places(spark, vocabulary, capacity):
    got = pack.digests(pack.pack(documents(spark), vocabulary, capacity=capacity)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(wanted_pieces(capacity), key=str)
    check_places(got, capacity)
    full = -(-sum(r["length"] for r in got) // capacity)
    assert len({r["sequence_id"] for r in got}) <= full * 1.05 + 1


def test_cut_of_sizes():
    sizes = np.array([1, 4, 5, 8, 13])
    want = [(d, k, at, min(4, n - at)) for d, n in enumerate(sizes.tolist()) for k, at in enumerate(range(0, n, 4))]
    assert list(zip(*(x.tolist() for x in pack.cut(sizes, 4)))) == want


def test_sequences_hold_their_pieces(spark, vocabulary):
    packed = pack.pack(documents(spark), vocabulary, capacity=64)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in pack.sequences(packed).collect()}
    for r in packed.pieces.join(packed.places, "row").collect():
        assert whole[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    assert sum(map(len, whole.values())) == 4 * sum(p[3] for p in wanted_pieces(64))


def test_no_documents(spark, vocabulary):
    packed = pack.pack(no_documents(spark), vocabulary)
    assert pack.digests(packed).count() == 0 and pack.sequences(packed).count() == 0


def test_every_place_has_the_least_sum_of_squares():
    r = random.Random(2)
    for capacity in (10, 37):
        sizes = np.array([r.randint(1, capacity - 1) for _ in range(300)])
        sequence, offset = pack.pack_sizes(sizes, capacity)
        held = []
        for size, s, at in zip(sizes.tolist(), sequence.tolist(), offset.tolist()):
            def cost(k):
                levels = [h + size * (j == k) for j, h in enumerate(held)] + [size] * (k == len(held))
                return sum(levels.count(h) ** 2 for h in range(1, capacity))
            choices = {k: cost(k) for k in range(len(held) + 1) if k == len(held) or held[k] + size <= capacity}
            assert choices[s] == min(choices.values())
            best = max((held[k] if k < len(held) else 0) for k in choices if choices[k] == choices[s])
            assert at == best == (held[s] if s < len(held) else 0)
            held[s:s + 1] = [at + size]


def test_groups_waste_no_more_than_one(spark):
    r = random.Random(4)
    sizes = [min(4095, 1 + int(r.lognormvariate(5.5, 1.2))) for _ in range(6000)]
    table = spark.createDataFrame(list(enumerate(sizes)), "row long, length long")
    placed = pack.place(table, group_pieces=200).join(table, "row").collect()
    assert len(placed) == len(sizes)
    assert check_places(placed, 4096) <= -(-sum(sizes) // 4096) * 1.03 + 2


def test_long_pieces_that_cannot_share_stay_in_bounded_groups(spark):
    sizes = [2100] * 3000 + [10] * 5
    table = spark.createDataFrame(list(enumerate(sizes)), "row long, length long")
    placed = pack.place(table, group_pieces=160).join(table, "row").collect()
    assert check_places(placed, 4096) <= 3001
