"""Removal of repeated byte strings by longest-previous-factor arrays (operator 5).

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier: in a document before this
one, or further left in the same document. Documents are ordered by id (NULL ids last, then by digest).

1. Every window of ``LENGTH`` bytes has an anchor: its smallest hashed ``GRAM``-byte string. Equal windows have
   equal anchors, so all occurrences of a repeated string meet under one anchor hash. Windows that follow each
   other and share their anchor are one segment.
2. Anchors are shuffled as packed numpy columns. Under an anchor hash equal segments (by a digest of their
   bytes) keep their first occurrence; the others are repeats throughout. A hash with one kind of segment is done.
3. Segments that share an anchor hash but differ are fetched from their texts. Each task sorts the suffixes of
   its segments in full, by prefix doubling, finds the previous and next smaller text position in suffix order and
   takes the longer of the two common prefixes: the longest previous factor, up to the segment's end. Where it has
   ``LENGTH`` bytes or more the window repeats.
4. The repeated windows of a document are merged to runs and cut out of its text.

Scale. Each text is read in pieces of ``PIECE`` bytes, so very long texts and lines repeated inside one cost
no more than others. Equal segments are reduced inside each task first. An anchor hash with more than ``HOT``
kinds of segments (a passage in a third of all documents, with other text around it) is not sent to one
task: its segments become windows, each a 128-bit digest with its place. A task keeps the first place of each of
its windows and marks the others as repeats, so of a window in a third of all documents one place per
``GATHER_WINDOWS`` fetched windows travels on, to the task of its digest. Tasks are counted by windows. Texts travel
compressed, once to fetch segments and once to cut the runs out. Nothing is collected.

Defined results. NULL text has no bytes. Of rows with the same id and text the first is the document and every
further one repeats it: all of it goes when it has ``LENGTH`` bytes. Texts shorter than ``LENGTH`` bytes stay
whole. An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import none_if_missing, stage
from opinio.llm.shingles import mix

LENGTH = 100
GRAM = 20
PIECE = 1 << 17
#: Text that a task gathers before it reduces and sends its anchors; text per anchor bucket.
GATHER_BYTES, BUCKET_BYTES = 48 << 20, 16 << 20
#: Kinds of segments of one anchor hash that may meet in one task; kinds that one task sends there.
HOT, LOCAL_HOT = 4096, 256
#: Segment bytes per task in step 3; windows of hot hashes that a task gathers before it reduces them; those of a task.
SUFFIX_BYTES, GATHER_WINDOWS, TASK_WINDOWS = 2 << 20, 1 << 20, 1 << 18

#: Common prefixes taken at once: few enough for a processor's cache.
PAIRS = 1 << 15

_U = np.uint64
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_ODD), -1, 1 << 64))
_POSITION = _U((1 << 20) - 1)  # pieces and chunks stay below 2^20 bytes
_TOP = _U(np.iinfo(np.uint64).max)


def _ahead(a: np.ndarray, n: int, fill) -> np.ndarray:
    out = np.full_like(a, fill)
    out[:max(0, len(a) - n)] = a[n:]
    return out


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each position on (meaningless where they cross the end)."""
    power, size, out, covered, rest = _BYTE[data], 1, np.zeros(len(data), _U), 0, width
    while rest:
        if rest & 1:
            out = out * _ODD + _ahead(power, covered, 0)
            out ^= out >> _U(29)
            covered += size
        rest >>= 1
        if rest:
            power = power * _ODD + _ahead(power, size, 0)
            power ^= power >> _U(31)
            size *= 2
    return mix(out)


def _window_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        a = np.minimum(a, _ahead(a, size, _TOP))
        size *= 2
    return np.minimum(a, _ahead(a, width - size, _TOP)) if size < width else a


def segments(pieces: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Segments of all pieces: (piece, start, windows, anchor hash, digest of the bytes)."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    ends = np.cumsum(sizes)
    n = len(data)
    h = gram_hashes(data, gram)
    at = np.arange(n, dtype=np.uint64)
    least = _window_min((h & ~_POSITION) | at, length - gram + 1) & _POSITION
    whole = np.flatnonzero(at.astype(np.int64) + length <= np.repeat(ends, sizes))
    if not len(whole):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, _U), np.zeros(0, _U)
    anchor = least[whole].astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1)])
    windows = np.diff(np.r_[first, len(whole)])
    start = whole[first]
    step, back = np.full(n + 1, _ODD, _U), np.full(n + 1, _INVERSE, _U)
    step[0] = back[0] = 1
    sums = np.r_[_U(0), np.cumsum(_BYTE[data] * np.cumprod(step, dtype=_U)[:n], dtype=_U)]
    stop = start + windows + length - 1
    digest = (sums[stop] - sums[start]) * np.cumprod(back, dtype=_U)[start]
    # The anchor's place in the segment is part of what must be equal.
    place = (anchor[first] - start).astype(_U)
    digest = mix(digest ^ mix(windows.astype(_U) * _U(1 << 16) + place + _U(1)))
    piece = np.searchsorted(ends, start, side="right")
    return piece, start - (ends - sizes)[piece], windows, h[anchor[first]], digest


def document_key(doc_id, data: bytes) -> tuple[int, int]:
    """(key, twin): the order of documents. Key is the id, or behind all ids 62 bits of a digest where it is NULL;
    twin, 64 other bits of it, tells texts with the same id apart."""
    d = hashlib.md5(data).digest()
    key = (1 << 62) + (int.from_bytes(d[8:], "little") >> 2) if doc_id is None else int(doc_id)
    return key, int.from_bytes(d[:8], "little", signed=True)


def _keys(pdf: pd.DataFrame) -> list[tuple[int | None, bytes]]:
    return [(None if pd.isna(i) else int(i), (none_if_missing(t) or "").encode()) for i, t in zip(pdf["doc_id"], pdf["text"])]


_ROWS = "bucket int, kind int, key long, twin long, spans binary, anchors binary, pack binary, windows long, size long"
REPEAT, FETCH, ANCHORS = 0, 1, 2
_FIELDS = (("anchor", "<u8"), ("digest", "<u8"), ("key", "<i8"), ("twin", "<i8"), ("start", "<i4"), ("windows", "<u1"),
           ("hot", "<u1"))
_WINDOW_FIELDS = (("high", "<u8"), ("low", "<u8"), ("key", "<i8"), ("twin", "<i8"), ("start", "<i4"))


def _pack(t: dict[str, np.ndarray], rows: np.ndarray, fields=_FIELDS) -> bytes:
    """Columns as byte planes: the many zero planes vanish in the shuffle's compression."""
    out = [np.int64(len(rows)).tobytes()]
    for name, kind in fields:
        column = np.ascontiguousarray(t[name][rows], dtype=kind)
        out.append(column.view(np.uint8).reshape(len(rows), -1).T.tobytes())
    return b"".join(out)


def _unpack(packs: list[bytes], fields=_FIELDS) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in fields}
    for pack in packs:
        n, at = int(np.frombuffer(pack[:8], np.int64)[0]), 8
        for name, kind in fields:
            width = np.dtype(kind).itemsize
            planes = np.frombuffer(pack, np.uint8, n * width, at).reshape(width, n)
            parts[name].append(np.ascontiguousarray(planes.T).view(kind).ravel())
            at += n * width
    return {name: np.concatenate(p) for name, p in parts.items()}


def _sort_kinds(t: dict[str, np.ndarray]):
    """Order by (anchor, digest, document, start); first row of each anchor and of each kind of segment, and the
    rows that repeat the first one of their kind. A repeated row of the table shows the same place of the same
    (key, twin) again; it repeats nothing there, or the document itself would lose what it holds first."""
    order = np.lexsort((t["start"], t["twin"], t["key"], t["digest"], t["anchor"]))
    anchor, digest = t["anchor"][order], t["digest"][order]
    new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
    new_kind = new_anchor | np.r_[True, digest[1:] != digest[:-1]]
    return order, new_anchor, new_kind, _elsewhere(t, order, new_kind)


def _elsewhere(t: dict[str, np.ndarray], order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Which rows, in ``order``, lie at another place than the first row of their run."""
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return ((t["key"][order] != t["key"][first]) | (t["twin"][order] != t["twin"][first])
            | (t["start"][order] != t["start"][first]))


def _by_document(t: dict[str, np.ndarray], rows: np.ndarray, kind: int) -> Iterator[pd.DataFrame]:
    """Rows grouped by document: spans as int32 (start, windows, hot) triples, and the anchor hashes; the number of
    windows in hot spans and of bytes in the others."""
    if not len(rows):
        return
    rows = rows[np.lexsort((t["start"][rows], t["twin"][rows], t["key"][rows]))]
    key, twin = t["key"][rows], t["twin"][rows]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (twin[1:] != twin[:-1])])
    spans = np.stack([t["start"][rows], t["windows"][rows].astype(np.int32), t["hot"][rows].astype(np.int32)], axis=1)
    spans, anchors = spans.astype(np.int32), t["anchor"][rows]
    edges = [*first.tolist(), len(rows)]
    hot, n = spans[:, 2] > 0, spans[:, 1].astype(np.int64)
    yield pd.DataFrame({
        "bucket": (mix(key[first].view(np.uint64)) >> _U(40)).astype(np.int32), "kind": np.int32(kind),
        "key": key[first], "twin": twin[first],
        "spans": [spans[a:b].tobytes() for a, b in zip(edges, edges[1:])],
        "anchors": [anchors[a:b].tobytes() if kind == FETCH else None for a, b in zip(edges, edges[1:])], "pack": None,
        "windows": np.add.reduceat(np.where(hot, n, 0), first), "size": np.add.reduceat(np.where(hot, 0, n + LENGTH - 1), first)})


def _find_anchors(buckets: int):
    def send(t: dict[str, list]) -> Iterator[pd.DataFrame]:
        if not t["anchor"]:
            return
        t = {name: np.concatenate(t[name]).astype(kind) for name, kind in _FIELDS}
        order, new_anchor, new_kind, repeats = _sort_kinds(t)
        yield from _by_document(t, order[repeats], REPEAT)
        group = np.cumsum(new_anchor) - 1
        hot = np.bincount(group, weights=new_kind)[group] > LOCAL_HOT
        nth = np.cumsum(new_kind) - np.r_[0, np.cumsum(new_kind)][np.flatnonzero(new_anchor)][group]
        t["hot"][order[hot]] = 1
        # Of a hash that is hot here, two kinds go on as a sign; all are fetched.
        yield from _by_document(t, order[hot & new_kind], FETCH)
        rows = order[new_kind & (~hot | (nth <= 2))]
        bucket = (t["anchor"][rows] >> _U(20)) % _U(buckets)
        by = np.argsort(bucket, kind="stable")
        rows, bucket = rows[by], bucket[by]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for k in range(0, len(cuts) - 1, 64):
            part = cuts[k:k + 65]
            yield pd.DataFrame({"bucket": bucket[part[:-1]].astype(np.int32), "kind": np.int32(ANCHORS), "key": np.int64(0),
                                "twin": np.int64(0), "spans": None, "anchors": None,
                                "pack": [_pack(t, rows[a:b]) for a, b in zip(part, part[1:])],
                                "windows": np.int64(0), "size": np.int64(0)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table: dict[str, list] = {name: [] for name, _ in _FIELDS}
        held = 0
        pieces, owners, offsets, waiting = [], [], [], 0

        def flush_pieces():
            nonlocal pieces, owners, offsets, waiting
            if pieces:
                piece, start, windows, anchor, digest = segments(pieces)
                owner = np.array(owners, dtype=np.int64).reshape(-1, 2)[piece]
                for name, column in (("anchor", anchor), ("digest", digest), ("key", owner[:, 0]), ("twin", owner[:, 1]),
                                     ("start", start + np.array(offsets)[piece]), ("windows", windows),
                                     ("hot", np.zeros(len(piece)))):
                    table[name].append(column)
            pieces, owners, offsets, waiting = [], [], [], 0

        for pdf in batches:
            for doc_id, data in _keys(pdf):
                if len(data) < LENGTH:
                    continue
                key = document_key(doc_id, data)
                for a in range(0, len(data) - LENGTH + 1, PIECE):
                    pieces.append(data[a:a + PIECE + LENGTH - 1])
                    owners.append(key)
                    offsets.append(a)
                    waiting += len(pieces[-1])
                    if waiting >= PIECE:
                        flush_pieces()
                held += len(data)
                if held >= GATHER_BYTES:
                    flush_pieces()
                    yield from send(table)
                    table, held = {name: [] for name, _ in _FIELDS}, 0
        flush_pieces()
        yield from send(table)
    return run


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 2 on one partition of anchor hashes; rows that are already decided pass."""
    packs: list[bytes] = []
    for pdf in batches:
        packs += [p for p in pdf["pack"] if p is not None]
        done = pdf[pdf["kind"] != ANCHORS]
        if len(done):
            yield done
    if not packs:
        return
    t = _unpack(packs)
    order, new_anchor, new_kind, repeats = _sort_kinds(t)
    yield from _by_document(t, order[repeats], REPEAT)
    group = np.cumsum(new_anchor) - 1
    kinds = np.bincount(group, weights=new_kind)[group]
    sign = t["hot"][order] > 0  # from a task that fetches its kinds itself
    t["hot"][order] = (np.bincount(group, weights=sign)[group] > 0) | (kinds > HOT)
    yield from _by_document(t, order[new_kind & (kinds > 1) & ~sign], FETCH)


#: A segment with its bytes, packed windows of hot hashes, or (spans) what is decided.
_SEGMENTS = "route long, key long, twin long, start int, windows int, bytes binary, pack binary, spans binary"


def _first_windows(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows at the first place of each window, and rows at the other places."""
    order = np.lexsort((t["start"], t["twin"], t["key"], t["low"], t["high"]))
    high, low = t["high"][order], t["low"][order]
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
    return order[new], order[_elsewhere(t, order, new)]


def _runs(t: dict[str, np.ndarray], rows: np.ndarray) -> pd.DataFrame:
    """The places of windows as (key, twin, spans), windows that follow each other in one span."""
    rows = rows[np.lexsort((t["start"][rows], t["twin"][rows], t["key"][rows]))]
    key, twin, start = t["key"][rows], t["twin"][rows], t["start"][rows].astype(np.int32)
    other = np.r_[True, (key[1:] != key[:-1]) | (twin[1:] != twin[:-1])][:len(rows)]
    first = np.flatnonzero(other | np.r_[True, start[1:] > start[:-1] + 1][:len(rows)])
    last = np.r_[first[1:], len(rows)][:len(first)] - 1
    spans = np.stack([start[first], start[last] - start[first] + 1, np.zeros(len(first), np.int32)], axis=1).astype(np.int32)
    edges = [*np.flatnonzero(other[first]).tolist(), len(first)]
    document = first[edges[:-1]]
    return pd.DataFrame({"key": key[document], "twin": twin[document],
                         "spans": [spans[a:b].tobytes() for a, b in zip(edges, edges[1:])]})


def _fetch(buckets: int):
    """Cut the wanted segments out of their texts; those of hot hashes become windows, reduced here first."""
    names = ["route", "key", "twin", "start", "windows", "bytes"]

    def send(held: list[tuple[bytes, int, int, int]]) -> Iterator[pd.DataFrame]:
        if not held:
            return
        digest = np.frombuffer(b"".join(d for d, *_ in held), "<u8").reshape(-1, 2)
        n = np.array([len(d) // 16 for d, *_ in held])
        place = np.array([h[1:] for h in held], dtype=np.int64)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        t = {"high": digest[:, 0], "low": digest[:, 1], "key": np.repeat(place[:, 0], n), "twin": np.repeat(place[:, 1], n),
             "start": np.repeat(place[:, 2], n) + inside}
        rows, repeats = _first_windows(t)
        if len(repeats):
            out = _runs(t, repeats)
            yield out.assign(route=out["key"], start=0, windows=0, bytes=None, pack=None)[[*names, "pack", "spans"]]
        bucket = t["high"][rows] % _U(buckets)
        by = np.argsort(bucket, kind="stable")
        rows, bucket = rows[by], bucket[by]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for k in range(0, len(cuts) - 1, 64):
            part = cuts[k:k + 65]
            yield pd.DataFrame({"route": bucket[part[:-1]].astype(np.int64), "key": np.int64(0), "twin": np.int64(0),
                                "start": np.int32(0), "windows": np.int32(0), "bytes": None,
                                "pack": [_pack(t, rows[a:b], _WINDOW_FIELDS) for a, b in zip(part, part[1:])], "spans": None})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unzip = zstandard.ZstdDecompressor()
        hot_spans, waiting = [], 0
        for pdf in batches:
            rows, held = [], 0
            for key, twin, z, spans, anchors in zip(pdf["key"], pdf["twin"], pdf["z"], pdf["spans"], pdf["anchors"]):
                data = unzip.decompress(z)
                spans = np.frombuffer(spans, np.int32).reshape(-1, 3)
                for (start, windows, hot), anchor in zip(spans.tolist(), np.frombuffer(anchors, np.int64).tolist()):
                    if hot:
                        digests = b"".join(hashlib.blake2b(data[a:a + LENGTH], digest_size=16).digest()
                                           for a in range(start, start + windows))
                        hot_spans.append((digests, key, twin, start))
                        waiting += windows
                    else:
                        rows.append((anchor, key, twin, start, windows, data[start:start + windows + LENGTH - 1]))
                        held += windows + LENGTH
                if held > 1 << 22:
                    yield pd.DataFrame(rows, columns=names).assign(pack=None, spans=None)
                    rows, held = [], 0
                if waiting >= GATHER_WINDOWS:
                    yield from send(hot_spans)
                    hot_spans, waiting = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names).assign(pack=None, spans=None)
        yield from send(hot_spans)
    return run


def _dense(a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
    """Dense ranks of the pairs (a, b), b below ``top``."""
    return np.unique(a * top + b, return_inverse=True)[1].astype(np.int64)


def _later(a: np.ndarray, k: int, ends: np.ndarray) -> np.ndarray:
    """What stands ``k`` bytes further on in the same segment, 0 behind its end."""
    return np.where(np.arange(len(a)) + k < ends, np.r_[a[k:], np.zeros(min(k, len(a)), a.dtype)], 0)


def suffix_levels(data: np.ndarray, ends: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Prefix doubling: (size, what tells the ``size`` bytes from each position on apart), each cut at ``ends`` (the end
    of the segment it lies in). Sizes 1, 2 and 4 are the bytes themselves, 7 and its doubles are ranks; the last size is
    at least half of the longest segment."""
    one = data.astype(np.int64) + 1  # 9 bits, 0 for the end
    two = one << 9 | _later(one, 1, ends)
    four = two << 18 | _later(two, 2, ends)
    seven = four << 27 | _later(two, 4, ends) << 9 | _later(one, 6, ends)
    size, rank = 7, np.unique(seven, return_inverse=True)[1].astype(np.int64) + 1
    levels = [(1, one.astype(np.int32)), (2, two.astype(np.int32)), (4, four), (7, rank.astype(np.int32))]
    longest = (ends - np.arange(len(data))).max(initial=0)
    while size * 2 < longest:
        rank, size = _dense(rank, _later(rank, size, ends), len(data) + 2) + 1, size * 2
        levels.append((size, rank.astype(np.int32)))
    return levels


def suffix_order(levels: list[tuple[int, np.ndarray]], ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``starts`` in the order of their suffixes; equal ones stay in place."""
    size, rank = levels[-1]
    rank = rank.astype(np.int64)
    return starts[np.argsort(rank[starts] * (len(rank) + 2) + _later(rank, size, ends)[starts], kind="stable")]


def common_prefix(levels: list[tuple[int, np.ndarray]], ends: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``i`` and at ``j``."""
    out, top = np.zeros(len(i), np.int64), len(ends) - 1
    for a in range(0, len(i), PAIRS):
        x, y = i[a:a + PAIRS], j[a:a + PAIRS]
        end_x, end_y, first = ends[x], ends[y], x
        for size, name in reversed(levels):
            same = (x < end_x) & (y < end_y) & (name[np.minimum(x, top)] == name[np.minimum(y, top)])
            step = np.where(same, np.minimum(size, end_x - x), 0)
            x, y = x + step, y + step
        out[a:a + PAIRS] = x - first
    return out


def nearest_smaller(position: np.ndarray, step: int) -> np.ndarray:
    """For each place the nearest one before it (step -1) or behind it (1) with a smaller position; -1 where none is."""
    n = len(position)
    near, active = np.arange(n) + step, np.arange(n)
    while len(active):
        at = near[active]
        inside = (at >= 0) & (at < n)
        near[active[~inside]] = -1
        active, at = active[inside], at[inside]
        larger = position[at] > position[active]
        active, at = active[larger], at[larger]
        near[active] = near[at]  # everything up to there has larger positions
    return near


def longest_previous_factors(data: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The LPF array: for each of the (rising) ``starts`` the length of the longest prefix of its suffix that a smaller
    start has as well. Among smaller positions the nearest ones in suffix order, on either side, share the most."""
    levels = suffix_levels(data, ends)
    order = suffix_order(levels, ends, starts)
    longest = np.zeros(len(data), np.int64)
    for step in (-1, 1):
        near = nearest_smaller(order, step)
        i, j = order[near >= 0], order[near[near >= 0]]
        longest[i] = np.maximum(longest[i], common_prefix(levels, ends, i, j))
    return longest[starts]


def _factors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 3 on one partition of segments: the runs of windows that repeat an earlier one."""
    parts, packs = [], []
    for pdf in batches:
        packs += [p for p in pdf["pack"] if p is not None]
        done = pdf[pdf["spans"].notna()]
        if len(done):
            yield done[["key", "twin", "spans"]]
        whole = pdf[pdf["bytes"].notna()]
        if len(whole):
            parts.append(whole)
    if packs:
        t = _unpack(packs, _WINDOW_FIELDS)
        repeats = _first_windows(t)[1]
        if len(repeats):
            yield _runs(t, repeats)
    if not parts:
        return
    # Tasks that hold a repeated row each send its segments: one of them is the document's.
    rows = pd.concat(parts, ignore_index=True).drop_duplicates(["key", "twin", "start"])
    rows = rows.sort_values(["key", "twin", "start"], ignore_index=True)
    windows, sizes = rows["windows"].to_numpy(), np.array([len(b) for b in rows["bytes"]], dtype=np.int64)
    data = np.frombuffer(b"".join(rows["bytes"]), dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    before = np.cumsum(windows) - windows
    inside = np.arange(windows.sum()) - np.repeat(before, windows)
    # Bytes are in the order of (document, start), so places in ``data`` rise with text positions. The tail of a segment
    # starts no window: these bytes start theirs in the next segment.
    ends = np.repeat(begin + sizes, sizes)
    hit = longest_previous_factors(data, ends, np.repeat(begin, windows) + inside) >= LENGTH
    owner = np.repeat(np.arange(len(rows)), windows)[hit]
    at = inside[hit]
    if not len(at):
        return
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])
    run = np.diff(np.r_[first, len(at)])
    owner, at = owner[first], rows["start"].to_numpy()[owner[first]] + at[first]
    spans = np.stack([at, run, np.zeros(len(run))], axis=1).astype(np.int32)
    yield pd.DataFrame({"key": rows["key"].to_numpy()[owner], "twin": rows["twin"].to_numpy()[owner],
                        "spans": [s.tobytes() for s in spans]})


_TEXTS = "doc_id long, key long, twin long, z binary"


def _zip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    press = zstandard.ZstdCompressor(level=1)
    for pdf in batches:
        rows = _keys(pdf)
        keys = [document_key(*r) for r in rows]
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").to_numpy(), "key": [k for k, _ in keys],
                            "twin": [t for _, t in keys], "z": [press.compress(d) for _, d in rows]})


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 4: merge the runs of each document and drop their bytes."""
    unzip = zstandard.ZstdDecompressor()
    for pdf in batches:
        out = []
        for z, spans, nth in zip(pdf["z"], pdf["spans"], pdf["nth"]):
            data = unzip.decompress(z)
            if nth > 1 and len(data) >= LENGTH:
                kept, runs = b"", 1
            elif spans is None or not len(spans):
                kept, runs = data, 0
            else:
                cover = np.zeros(len(data) + 1, dtype=np.int64)
                s = np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 3) for x in spans])
                np.add.at(cover, s[:, 0], 1)
                np.add.at(cover, s[:, 0] + s[:, 1] + LENGTH - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                runs = int((gone & ~np.r_[False, gone[:-1]]).sum())
            out.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
        columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pd.concat([pdf[["doc_id"]].astype("Int64").reset_index(drop=True), pd.DataFrame(out, columns=columns)], axis=1)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay): one row per input row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    anchors = docs.mapInPandas(_find_anchors(buckets), _ROWS)
    met = stage(anchors.repartition(buckets, "bucket").mapInPandas(_meet, _ROWS), "segments").drop("bucket", "pack")
    texts = docs.mapInPandas(_zip, _TEXTS)

    wanted = met.where(F.col("kind") == FETCH).select("key", "twin", "spans", "anchors")
    size, windows = met.where(F.col("kind") == FETCH).agg(F.sum("size"), F.sum("windows")).first()
    tasks = max(1, -(-(size or 0) // SUFFIX_BYTES) - (-(windows or 0) // TASK_WINDOWS))
    fetched = wanted.join(texts.dropDuplicates(["key", "twin"]).drop("doc_id"), ["key", "twin"])
    fetched = fetched.mapInPandas(_fetch(tasks), _SEGMENTS)
    factors = stage(fetched.repartition(tasks, "route").mapInPandas(_factors, "key long, twin long, spans binary"), "factors")

    spans = (met.where(F.col("kind") == REPEAT).select("key", "twin", "spans").unionByName(factors)
             .groupBy("key", "twin").agg(F.collect_list("spans").alias("spans")))
    nth = F.row_number().over(Window.partitionBy("key", "twin").orderBy(F.lit(1)))
    rows = texts.withColumn("nth", nth).join(spans, ["key", "twin"], "left")
    return rows.select("doc_id", "z", "spans", "nth").mapInPandas(
        _cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
