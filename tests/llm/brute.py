"""Brute-force versions used by several tests."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict


def n_words(text) -> int:
    return len(re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))


def targets(sizes: dict) -> dict:
    """Target of each source: weights 5, 2, 1 in code-point order (None last), capped at three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in capped)
        level = (total - sum(3 * sizes[s] for s in capped)) / rest if rest else 0
        more = {s for s in names if s not in capped and 3 * sizes[s] < level * weight[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= more


def mix(rows: list[tuple], block_words: int = 1024) -> tuple[list[tuple], dict]:
    """(doc_id, size, source_size, target, taken) of (doc_id, source, text) rows with distinct ids."""
    size = {i: n_words(t) for i, _, t in rows}
    text_key = {i: "" if t is None else hashlib.md5(t.encode()).hexdigest() for i, _, t in rows}
    by_source = defaultdict(list)
    for i, s, _ in rows:
        by_source[s].append(i)
    sizes = {s: sum(size[i] for i in ids) for s, ids in by_source.items()}
    target = targets(sizes)
    total = sum(sizes.values())
    block = max(1, min(block_words, int(min((t for t in target.values() if t > 0), default=0)) // 256))
    root5 = math.isqrt(5 << 240)  # 2^120 * sqrt(5)
    step = ((root5 - (1 << 120)) >> 49) | 1  # 2^72 / golden ratio, odd
    edges, at = [], 0.0
    for s, t in target.items():
        at += t
        edges.append((at, s))
    slots = defaultdict(int)
    for i in range(-(-total // block)):
        x = ((i * step % 2**72 >> 24) + 0.5) / 2**48 * total
        slots[next((s for hi, s in edges if x < hi), edges[-1][1])] += 1
    out = []
    for s, ids in by_source.items():
        ids = sorted(ids, key=lambda i: (hashlib.md5(f"mix:{i}:{text_key[i]}".encode()).hexdigest(), i))
        start, limit = 0, slots[s] * block
        for i in ids:
            taken = sum(max(0, min(start + k * sizes[s] + size[i], limit) - min(start + k * sizes[s], limit)) for k in range(3))
            out.append((i, size[i], sizes[s], target[s], taken))
            start += size[i]
    return out, slots
