"""BPE against the tokenizers library, and the exact digests of the query."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opinio.llm import bpe
from tests.llm.fixture import documents, no_documents, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


def odd_texts():
    r = random.Random(1)
    old = unicodedata.ucd_3_2_0  # characters every Unicode version in use knows
    ranges = [(0x20, 0x7F), (1, 0x2100), (0x2000, 0x3100), (1, 0xD7FF), (0x10000, 0x1FFFF)]
    out = []
    for _ in range(800):
        text = "".join(chr(r.choice([r.randrange(*r.choice(ranges)), 0x3A3, 0x130, 0x20, 0x27, 0x73, 0x301, 0x61])) for _ in range(40))
        out.append("".join(c for c in text if old.category(c) != "Cn"))
    return out + ["<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "aaaaaaaaaaaa" * 700, "", "  ", "don't I'LL we've '''s",
                  "a\x1cb\x1fc᠎d​e﻿f\x85g", "word " * 3000]


def test_same_ids_and_text_as_the_library(library, vocabulary, monkeypatch):
    texts = odd_texts() + [t or "" for _, t, *_ in rows()]
    want = library.encode_batch(texts, add_special_tokens=False)
    for segment, cache in ((bpe.SEGMENT_CHARS, bpe.CACHE_CHUNKS), (64, 50)):
        monkeypatch.setattr(bpe, "SEGMENT_CHARS", segment)
        monkeypatch.setattr(bpe, "CACHE_CHUNKS", cache)
        encoder = bpe.Encoder(vocabulary)
        got = encoder.encode(texts)
        assert [g.tolist() for g in got] == [w.ids for w in want]
        assert [encoder.decode(g) for g in got] == [library.decode(w.ids, skip_special_tokens=False) for w in want]


def test_one_merge_per_round_gives_the_same(library, vocabulary):
    vocabulary = bpe.load(PATH)
    assert vocabulary.ordered
    vocabulary.ordered = False
    texts = ["aaaaaaa bananarama hahahaha", "internationalisation"]
    assert [g.tolist() for g in bpe.Encoder(vocabulary).encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_operator_on_awkward_rows(spark, library, vocabulary):
    got = sorted(map(tuple, bpe.digests(bpe.bpe(documents(spark), vocabulary)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.bpe(no_documents(spark), vocabulary).count() == 0


def test_rounds_look_up_new_pairs_only(monkeypatch):
    """Every position once, then the two pairs that a merge makes; known chunks keep their numbers."""
    v, looked = bpe.load(PATH), []
    words = [w.encode() for w in ("representation", "aaaaaaa", "internationalisation", "q")] * 50
    search = np.searchsorted
    monkeypatch.setattr(bpe.np, "searchsorted", lambda keys, x: looked.append(len(x)) or search(keys, x))
    ids, counts = bpe.merge_words(words, v)
    size = sum(map(len, words))
    assert sum(looked) <= size + 2 * (size - len(ids))
    numbers = bpe.Numbers({"a": 0})
    assert [numbers[c] for c in ("b", "a", "c", "b")] == [1, 0, 2, 1] and numbers.new == ["b", "c"]


def test_words_are_merged_once(monkeypatch, vocabulary):
    """A word is learned once, whatever stands around it; only words go to the merge rounds."""
    merged, merge = [], bpe.merge_words
    monkeypatch.setattr(bpe, "merge_words", lambda words, v: merged.extend(words) or merge(words, v))
    encoder = bpe.Encoder(vocabulary)
    for text in ("alpha beta", "(alpha), Beta! alpha's", "alpha;beta 12 beta's"):
        encoder.encode([text])
    assert sorted(merged) == sorted({b"alpha", b"beta", b"(", b"),", b"!", b"'s", b";", b"1", b"2"})


def test_kinds_of_characters_and_the_pattern_give_the_same_words(library, vocabulary):
    r = random.Random(3)
    short = ["'", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "s", "l", "e", "\u00e9", "\u0301", "7", "\u0663", "\U0001d7d8", " ", "\u2003", "\u4e2d", "-", "\u0130"]
    texts = ["".join(r.choices(short, k=30)) for _ in range(500)] + odd_texts()
    by_pattern = bpe.load(PATH)
    by_pattern.kinds = None
    want = [w.ids for w in library.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in bpe.Encoder(vocabulary).encode(texts)] == want
    assert [g.tolist() for g in bpe.Encoder(by_pattern).encode(texts)] == want


def test_special_tokens_inside_texts(library, vocabulary):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "", "x", "<|startoftext|><|endoftext|> y <|startoftext|>", None]
    got = bpe.Encoder(vocabulary).encode(texts)
    assert [g.tolist() for g in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert bpe.Encoder(vocabulary).encode_flat([])[0].tolist() == []
