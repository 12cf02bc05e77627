"""BPE encoding and decoding (operator 10): batched numpy merge rounds.

A text is cut at the special tokens and normalised (NFC, lower case). The words of all texts of a batch are found at once:
every byte gets the kind of its character, and words begin where the kind changes (vocabularies with another pattern are
split by that pattern). Arrow numbers the distinct words of the batch. Every word not seen before is put, as symbol ids, into
one flat array with the other new ones. A round looks up all new adjacent pairs at once by
binary search over the sorted pair keys, takes the lowest rank of each word and merges it wherever
it stands in that word; words without a known pair leave the array. Known words are a dictionary
look-up, and the ids of a batch are gathered from one flat table.

The vocabulary (bounded by its file) is read on the driver and broadcast. Texts are handled in
segments of about a million characters cut at white space, so a very long text needs no more memory
than its own tokens. Rows are independent: no shuffle, and a lost task is simply run again.

Defined results. NULL text encodes like the empty text: no ids, decoded ''. Only the id and text
columns are read; repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters that one segment of a text and one output batch hold, about.
SEGMENT_CHARS = 1 << 20
#: Words that a worker remembers before it starts anew.
CACHE_CHUNKS = 400_000

# The Unicode White_Space characters, in code-point order.
WHITE_SPACE = "".join(map(chr, (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_SPACES = re.compile(f"[{WHITE_SPACE}]+")
_NO_RANK = np.iinfo(np.int64).max
#: The pattern whose words are found by kinds of characters; the kinds.
KINDS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SEPARATOR, LETTER, NUMBER, OTHER = range(4)


def byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others take code points from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """What encoding needs, as plain arrays (broadcast to the workers)."""

    names: list[str]           # token string of each id
    middle: np.ndarray         # id of a byte inside a word
    last: np.ndarray           # id of a byte that ends a word
    keys: np.ndarray           # sorted pair keys: left * len(names) + right
    ranks: np.ndarray          # rank of each key
    merged: np.ndarray         # id that each key merges to
    pattern: str               # words of a normalised text
    special: dict[str, int]    # strings found in the raw text
    ordered: bool              # every pair ranks behind the merges that make its parts
    kinds: np.ndarray | None   # kind of each code point; None if the pattern is another one


def kinds_of_characters() -> np.ndarray:
    """Kind of each code point, as the pattern's own classes have it."""
    kinds = np.full(0x110000, SEPARATOR, dtype=np.uint8)
    for a, b in ((0, 0xD800), (0xE000, 0x110000)):  # all but the surrogates
        chars = "".join(map(chr, range(a, b)))
        for kind, some in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (OTHER, r"[^\s\p{L}\p{N}]+")):
            for m in regex.finditer(some, chars, regex.V0):
                kinds[a + m.start():a + m.end()] = kind
    kinds[list(map(ord, WHITE_SPACE))] = SEPARATOR
    return kinds


def load(path: str) -> Vocabulary:
    """Read a word-end BPE vocabulary file (JSON with ``model`` and ``added_tokens``)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
    vocab = dict(model["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max(vocab.values()) + 1
    names = [""] * size
    for token, i in vocab.items():
        names[i] = token
    chars = byte_names()
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
    merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    made = np.full(size, -1, dtype=np.int64)
    np.maximum.at(made, merged, np.arange(len(pairs)))
    keys = left * size + right
    order = np.argsort(keys, kind="stable")
    pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return Vocabulary(
        names, np.array([vocab[c] for c in chars]), np.array([vocab[c + suffix] for c in chars]),
        keys[order], order.astype(np.int64), merged[order], pattern,
        {t["content"]: t["id"] for t in spec["added_tokens"]},
        bool((np.maximum(made[left], made[right]) < np.arange(len(pairs))).all()),
        kinds_of_characters() if pattern == KINDS_PATTERN else None)


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one flat array, and the number of ids of each word."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    sym, word = v.middle[data], np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths) - 1
    sym[ends] = v.last[data[ends]]

    def look_up(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pairs whose left symbols stand there, and what they merge to; a word's last symbol has no pair."""
        right = np.minimum(left + 1, len(sym) - 1)
        key = sym[left] * len(v.names) + sym[right]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        known = (v.keys[at] == key) & (word[left] == word[right]) & (left < right)
        return np.where(known, v.ranks[at], _NO_RANK), v.merged[at]

    rank, merged = look_up(np.arange(len(sym)))
    done_sym, done_word = [], []
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.minimum.reduceat(rank, starts)
        count = np.diff(np.r_[starts, len(sym)])
        finished = np.repeat(best == _NO_RANK, count)
        hit = (rank == np.repeat(best, count)) & ~finished
        if not v.ordered:  # one merge per word and round
            first = np.flatnonzero(hit)
            hit[:] = False
            hit[first[np.r_[True, word[first][1:] != word[first][:-1]]] if len(first) else first] = True
        # Overlapping hits (aaa): from the left, every other one of a run.
        pos = np.flatnonzero(hit)
        if len(pos):
            new_run = np.r_[True, (pos[1:] != pos[:-1] + 1) | (word[pos[1:]] != word[pos[:-1]])]
            run_start = pos[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
            pos = pos[(pos - run_start) % 2 == 0]
        sym[pos] = merged[pos]
        done_sym.append(sym[finished])
        done_word.append(word[finished])
        keep = ~finished
        keep[pos + 1] = False
        sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
        # Only the pairs that a merged symbol is part of are new.
        new = (np.cumsum(keep) - 1)[pos]
        for left in (new, new[new > 0] - 1):
            rank[left], merged[left] = look_up(left)
    ids, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
    return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


def word_bounds(data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and lengths of the words of ``KINDS_PATTERN`` in a UTF-8 text between line ends, and which bytes they hold."""
    kind = kinds[data]
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
        lead = np.flatnonzero((data >= low) & (data < high))
        code = data[lead].astype(np.int32) & 0x7F >> size
        for k in range(1, size):
            code = code << 6 | data[lead + k] & 0x3F
        for k in range(size):
            kind[lead + k] = kinds[code]
    # A number is a word of its own; a character's later bytes begin nothing.
    begins = np.r_[True, ((kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)) & (data[1:] & 0xC0 != 0x80)]
    # An apostrophe alone takes the letters of a short form with it.
    at = np.flatnonzero(data == ord("'"))
    at = at[begins[at]]
    at = at[kind[at + 1] == LETTER]
    a, b = data[at + 1], data[at + 2]
    one = np.isin(a, list(b"stmd"))
    two = np.isin(a, list(b"rv")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    begins[at[one | two] + 1] = False
    begins[at[one] + 2] = begins[at[two] + 3] = True
    first = np.flatnonzero(begins)
    size, is_word = np.diff(first, append=len(data)), kind[first] != SEPARATOR
    return first[is_word], size[is_word], kind != SEPARATOR


def _gather(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``flat[offsets[r]:offsets[r + 1]]`` of all rows one behind the other, and their lengths."""
    first, size = offsets[rows], offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(size)
    return flat[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)], size


class Numbers(dict):
    """Numbers words as they are first asked for; ``new`` lists those numbered since it was last emptied."""

    def __init__(self, known: dict[str, int]) -> None:
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes batches of texts; remembers the words it has seen."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.words = regex.compile(f"\\n|(?:{v.pattern})", regex.V0)
        self.special = re.compile("(" + "|".join(re.escape(s) for s in v.special) + ")") if v.special else None
        self.names = np.array(v.names, dtype=object)
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers({"\n": 0})  # a line end has no ids
        self.flat = np.zeros(0, dtype=np.int32)
        self.offsets = np.zeros(2, dtype=np.int64)

    def _segments(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SEGMENT_CHARS:
            cut = _SPACES.search(text, at + SEGMENT_CHARS)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:] if at else text

    def _parts(self, text: str) -> list[str]:
        """The special tokens of a text, and what lies between them."""
        return self.special.split(text) if any(map(text.__contains__, self.v.special)) else [text]

    def _normal(self, part: str) -> bytes:
        # Lower case goes character by character (no rule for a final sigma). No special token is a word.
        return b"" if part in self.v.special else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower().encode()

    def _words(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all parts one behind the other, and how many each part has."""
        if self.v.kinds is None:
            found = [self.words.findall(_SPACES.sub("\n", p.decode())) for p in parts]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((self.known[w] for some in found for w in some), np.int64, lengths.sum()), lengths
        data = np.frombuffer(b"\n".join([b"", *parts, b""]), dtype=np.uint8)
        first, size, held = word_bounds(data, self.v.kinds)
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [
            None, pa.py_buffer(np.r_[0, np.cumsum(size)]), pa.py_buffer(data[held])]).dictionary_encode()
        end = pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary())
        lines = pc.binary_join_element_wise(words.dictionary, *end).buffers()[2]
        distinct = lines.to_pybytes().decode().split("\n")[:-1] if lines else []
        # One look at each word: the table numbers those that it does not know yet.
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        begins = np.cumsum([1] + [len(p) + 1 for p in parts])
        return numbers[words.indices.to_numpy()], np.diff(np.searchsorted(first, begins))

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts one behind the other, and the number of ids of each."""
        if len(self.known) > CACHE_CHUNKS:
            self._forget()
        known = self.known
        rows, lengths = self._words(list(map(self._normal, parts)))
        if known.new:
            new, known.new = known.new, []
            ids, counts = merge_words([w.encode() for w in new], self.v)
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])
        ids, size = _gather(self.flat, self.offsets, rows)
        counts = np.diff(np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(lengths)]])
        special = [k for k, p in enumerate(parts) if p in self.v.special]
        if special:
            ids = np.insert(ids, (np.cumsum(counts) - counts)[special], [self.v.special[parts[k]] for k in special])
            counts[special] = 1
        return ids, counts

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """int32 ids of all texts one behind the other, and the number of ids of each; a missing text has none."""
        parts = [(k, p) for k, t in enumerate(texts) for s in self._segments(t or "") for p in self._parts(s)]
        found, counts, a = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), 0
        while a < len(parts):
            b, chars = a, 0
            while b < len(parts) and (b == a or chars + len(parts[b][1]) <= 4 * SEGMENT_CHARS):
                chars += len(parts[b][1])
                b += 1
            ids, size = self._encode([p for _, p in parts[a:b]])
            found.append(ids)
            np.add.at(counts, [k for k, _ in parts[a:b]], size)
            a = b
        return np.concatenate(found), counts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """int32 ids of each text."""
        ids, counts = self.encode_flat(texts)
        return np.split(ids, np.cumsum(counts)[:-1])

    def decode(self, ids: np.ndarray) -> str:
        """The token strings joined by one space (the vocabulary has no decoder of its own)."""
        return " ".join(self.names[ids])


def bpe(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string: the tokens of every whole text and their decoded form."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars < SEGMENT_CHARS):
                    chars += len(texts[b] or "")
                    b += 1
                ids = encoder.encode(texts[a:b])
                offsets = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), pa.ListArray.from_arrays(offsets, np.concatenate(ids)),
                     pa.array([encoder.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])
                a = b

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``bpe``'s rows, and ``more`` of its columns."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)
