"""Best-fit packing (operator 13): the sum-of-squares rule.

A document is its token ids and one closing id. What is longer than a sequence is cut into whole sequences and a
last piece. The pieces are placed one by one, the longest first: each goes where the sum over all gaps of the
squared number of open sequences with that gap becomes smallest, be it an open sequence or a new one, and of
equal places into the fullest (best fit). Long pieces first leaves the short ones to close the gaps.

Scale. Texts are encoded once; the staged pieces hold their ids, and only (piece, length) pairs are shuffled to be
placed. Pieces are dealt at random into groups of about ``GROUP_PIECES``, each placed on its own. A sequence that a group
leaves with a gap over ``SLACK`` is taken apart again: its pieces go to the next round, in which ``FAN_IN`` groups become
one, until one group is left, so what the corpus wastes by being cut into groups is about one group's remainder. A group
passes on at most ``GROUP_PIECES / FAN_IN`` pieces, those of its emptiest sequences (it closes all but a few), so the
groups of every round are of the same size; sequences that no left piece can join stay as they are.

Defined results. NULL and empty texts are the closing id alone, one piece of length 1. Repeated rows, also with NULL
ids, are documents of their own. A document that fills sequences exactly has no further piece. Without documents the
result is empty. Ids of sequences are arbitrary, and differ between runs. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.bpe import SEGMENT_CHARS, Encoder, Vocabulary
from opinio.llm.common import RowIds, stage

CAPACITY, CLOSING = 4096, 1
#: Characters that are encoded and cut together, about.
BATCH_CHARS = 4 * SEGMENT_CHARS
#: Pieces that are placed together, on average; groups of a round that become one; tokens that a closed sequence may lack.
GROUP_PIECES, FAN_IN, SLACK = 8192, 16, 32
_NEVER = np.int32(1 << 30)

PIECES = "row long, doc_id long, piece int, start long, length long, ids binary"


@dataclass
class Packed:
    pieces: DataFrame  # row, doc_id, piece, start, length, ids (little-endian uint32)
    places: DataFrame  # row, sequence_id, offset


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document (from 0), number in it, start and length of every piece of documents of these sizes (1 at least)."""
    pieces = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    return doc, piece, start, np.minimum(capacity, sizes[doc] - start)


def cut_documents(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """The pieces of every document, with their ids as little-endian uint32."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows = Encoder(shared.value), RowIds()
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars < BATCH_CHARS):
                    chars += len(texts[b] or "")
                    b += 1
                ids, counts = encoder.encode_flat(texts[a:b])
                doc, piece, start, length = cut(counts + 1, capacity)
                offsets = np.r_[0, np.cumsum(length)]
                closed = np.insert(ids, np.cumsum(counts), closing).astype("<u4")
                row = rows.take(len(doc)) + np.arange(len(doc))
                binary = pa.Array.from_buffers(pa.binary(), len(doc), [
                    None, pa.array(4 * offsets, pa.int32()).buffers()[1], pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row, pa.int64()), keys.slice(a, b - a).take(pa.array(doc)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), binary], names=names)
                a = b

    return docs.mapInArrow(run, PIECES)


class OpenSequences:
    """Open sequences by level (tokens held); ``count[level]`` of each."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int32)
        self.at: dict[int, list[int]] = {}

    def level_for(self, size: int) -> int:
        """The level whose sequence should take ``size`` tokens; 0 for a new sequence.

        Moving a sequence from level h to h + size changes the sum of squares by 2 * (count[h + size] - count[h]) + 2;
        levels 0 and ``capacity`` are not counted.
        """
        before, after = self.count[:self.capacity - size + 1], self.count[size:]
        change = 2 * (after - before) + 2
        change[before == 0] = _NEVER
        if before[-1]:
            change[-1] = 1 - 2 * before[-1]  # it is full then
        change[0] = 2 * after[0] + 1 if size < self.capacity else 0
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def place(self, size: int, new: int) -> tuple[int, int]:
        """(sequence, level before); ``new`` names a new sequence."""
        level = self.level_for(size)
        sequence = self.at[level].pop() if level else new
        if level:
            self.count[level] -= 1
        if level + size < self.capacity:
            self.count[level + size] += 1
            self.at.setdefault(level + size, []).append(sequence)
        return sequence, level


def pack_sizes(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each size, in the order given."""
    open_ones, made = OpenSequences(capacity), 0
    sequence, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for k, size in enumerate(sizes.tolist()):
        sequence[k], offset[k] = open_ones.place(size, made)
        made += sequence[k] == made
    return sequence, offset


def _place_group(pdf: pd.DataFrame, capacity: int, slack: int, most: int) -> pd.DataFrame:
    """Places of a group's pieces; ``again`` marks those, ``most`` at most, that the next round places anew."""
    pdf = pdf.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
    sizes = pdf["length"].to_numpy()
    sequence, offset = pack_sizes(sizes, capacity)
    gap = capacity - np.bincount(sequence, sizes).astype(np.int64)
    # A gap that no piece of another open sequence fits is final; of the others the emptiest go on.
    opened = gap[sequence] > slack
    useful = (gap > slack) & (gap >= (sizes[opened].min() if opened.any() else 0))
    emptiest = np.argsort(-gap, kind="stable")
    emptiest = emptiest[useful[emptiest]]
    useful[emptiest[np.cumsum(np.bincount(sequence)[emptiest]) > most]] = False
    name = pd.Series(pdf["row"]).groupby(sequence).min().to_numpy()
    return pd.DataFrame({"row": pdf["row"], "length": sizes, "sequence_id": name[sequence], "offset": offset,
                         "again": useful[sequence]})


def place(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, slack: int = SLACK) -> DataFrame:
    """row, sequence_id, offset of every (row, length)."""
    schema = "row long, length long, sequence_id long, offset long, again boolean"
    full = pieces.where(F.col("length") == capacity)
    done = full.select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < capacity).select("row", "length")
    groups, number = max(1, -(-left.count() // group_pieces)), 0
    while True:
        last, number = groups == 1, number + 1
        most = 0 if last else group_pieces // FAN_IN
        group = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return _place_group(pdf, capacity, slack, most)

        placed = stage(left.groupBy(group.alias("group")).applyInPandas(run, schema), "placed")
        done = done.unionByName(placed.where("not again").select("row", "sequence_id", "offset"))
        if last:
            return done
        left, groups = placed.where("again").select("row", "length"), -(-groups // FAN_IN)


def pack(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, closing: int = CLOSING) -> Packed:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stage(cut_documents(src, vocabulary, capacity, closing), "pieces")
    return Packed(pieces, place(pieces.select("row", "length"), capacity))


def sequences(packed: Packed) -> DataFrame:
    """sequence_id, ids (little-endian uint32 of all its pieces, in order), n_pieces: at most ``capacity`` ids a row."""
    rows = packed.pieces.select("row", "ids").join(packed.places, "row")
    joined = F.aggregate("parts", F.lit(bytearray()), lambda ids, part: F.concat(ids, part["ids"]))
    return (rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", joined.alias("ids"), F.size("parts").alias("n_pieces")))


def digests(packed: Packed) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: ids stay where they are, only digests are joined."""
    pieces = packed.pieces.select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pieces.join(packed.places, "row").drop("row")
