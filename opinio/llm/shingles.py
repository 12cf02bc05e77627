"""Distinct word shingles of whole texts as sorted 64-bit hashes, computed for many texts at once in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A text with fewer words than the shingle width
has its whole word sequence as its only shingle; a text without words, or no text, has none.
"""

from __future__ import annotations

import re

import numpy as np

WIDTH = 5
#: Bytes hashed at once; a word longer than this is still one word.
PART_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_P = np.uint64(0x9E3779B97F4A7C15)  # odd base of the position weights
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _P, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hash_run(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(d) + 1 for d in data], dtype=np.int64)
    byte = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)
    inside = (byte != 32) & ((byte < 9) | (byte > 13))
    first = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(data), np.int64)
    last = np.flatnonzero(inside & ~np.r_[inside[1:], False])
    length = last - first + 1
    where = np.flatnonzero(inside)
    begin = np.cumsum(length) - length
    place = np.arange(len(where)) - np.repeat(begin, length)
    value = _BYTE[byte[where]] * _powers(int(length.max()))[place]
    counts = np.diff(np.r_[0, np.searchsorted(first, np.cumsum(sizes))])
    return mix(np.add.reduceat(value, begin) + length.astype(np.uint64)), counts


def _parts(data: bytes) -> list[bytes]:
    """A long text in parts of about ``PART_BYTES``, cut behind a white space."""
    parts, at = [], 0
    while len(data) - at > PART_BYTES:
        cut = _SPACE.search(data, at + PART_BYTES)
        if cut is None:
            break
        parts.append(data[at:cut.end()])
        at = cut.end()
    return [*parts, data[at:]]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and the number of words of each text."""
    parts, owner = [], []
    for k, t in enumerate(texts):
        for part in _parts(b"" if t is None else t.encode().lower()):
            parts.append(part)
            owner.append(k)
    hashes, total, a = [np.zeros(0, np.uint64)], np.zeros(len(texts), dtype=np.int64), 0
    while a < len(parts):
        b, held = a, 0
        while b < len(parts) and (b == a or held + len(parts[b]) <= PART_BYTES):
            held += len(parts[b])
            b += 1
        found, counts = _hash_run(parts[a:b])
        hashes.append(found)
        np.add.at(total, owner[a:b], counts)
        a = b
    return np.concatenate(hashes), total


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The set of each text: sorted distinct uint64 hashes."""
    hashes, counts = word_hashes(texts)
    weight = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.r_[hashes, np.zeros(width, np.uint64)]
    full = np.zeros(len(hashes), dtype=np.uint64)
    for j in range(width):
        full += padded[j:j + len(hashes)] * weight[j]
    full = mix(full + np.uint64(width))
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(full[at:at + n - width + 1]))
        elif n:
            short = (hashes[at:at + n] * weight[:n]).sum(dtype=np.uint64)
            out.append(mix(np.array([short + np.uint64(n)])))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def same_enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |intersection| >= percent * |union|, and neither set empty."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
