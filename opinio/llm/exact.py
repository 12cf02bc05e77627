"""Exact dedup by deterministic block naming (operator 8).

Each normalised text is cut into fixed-size blocks. Sorting the distinct blocks gives every
block content one integer name. Adjacent names of a document are then paired and each distinct
pair gets a new integer name, until every document has one name. Contents are compared in full
and pairs as integers, so two documents share (rounds, name) exactly when their texts are equal:
no hash decides equality.

Scale. Whole texts are shuffled once, as blocks of at most ``BLOCK_BYTES``: a task first numbers
its own distinct blocks, so a block that a third of all rows share is shuffled once per task, and a
very long text is spread over many rows. All later rounds move integers only; a text of n blocks
takes ceil(log2 n) rounds and leaves the loop when it has one name.

Defined results. NULL text counts as empty. Rows are told apart by position, so repeated rows and
repeated or NULL ids are fine: of equal texts exactly one row stays, the one with the smallest id
(NULL ids last); ``keep_id`` is its id. An empty table gives an empty result. Only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import ASCII_SPACE, RowIds, none_if_missing, one_of_each, packed, stage

BLOCK_BYTES = 8192
#: Bytes of distinct blocks that one task remembers; beyond it starts anew (more names to merge, same result).
LOCAL_BYTES = 64 << 20

_BLOCKS = "rid long, doc_id long, sha string, n_blocks int, block_no int, local long, block binary"


def normalise(text: str | None) -> bytes:
    """UTF-8 bytes with each run of ASCII white space replaced by one space; empty for NULL."""
    data = b"" if text is None else text.encode()
    out = b" ".join(data.split())
    if data and data[0] in ASCII_SPACE:
        out = b" " + out
    if data and data[-1] in ASCII_SPACE and out != b" ":
        out += b" "
    return out


def _cut(block_bytes: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, known, held = RowIds(), {}, 0
        for pdf in batches:
            rows = []
            for doc_id, missing, text in zip(pdf["doc_id"], pdf["doc_id"].isna(), pdf["text"]):
                data = normalise(none_if_missing(text))
                rid, sha = ids.take(), hashlib.sha256(data).hexdigest()
                n = max(1, -(-len(data) // block_bytes))
                for k in range(n):
                    block = data[k * block_bytes:(k + 1) * block_bytes]
                    local = known.get(block)
                    new = local is None
                    if new:
                        if held > LOCAL_BYTES:
                            known, held = {}, 0
                        local = known[block] = ids.take()
                        held += len(block) + 100
                    rows.append((rid, None if missing else int(doc_id), sha if k == 0 else None, n, k, local,
                                 block if new else None))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _BLOCKS.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
    return cut


def _name_pairs(seq: DataFrame) -> DataFrame:
    """One round: pair adjacent names of each document; equal pairs get one new name."""
    pairs = (seq.groupBy("rid", F.expr("block_no div 2").cast("int").alias("block_no"))
             .agg(F.min(F.when(F.col("block_no") % 2 == 0, F.col("name"))).alias("a"),
                  F.coalesce(F.min(F.when(F.col("block_no") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
                  F.first("left_over").alias("left_over")))
    pairs = stage(pairs, "block-pairs")
    # Sorted distinct pairs, numbered in order and frozen in the staged table.
    names = stage(pairs.select("a", "b").distinct().sort("a", "b")
                  .withColumn("name", F.monotonically_increasing_id()), "pair-names")
    return (pairs.join(names, ["a", "b"])
            .select("rid", "block_no", "name", ((F.col("left_over") + 1) / 2).cast("int").alias("left_over")))


def document_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: rid, doc_id, sha (of the normalised text) and its identity (rounds, name)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stage(src.mapInPandas(_cut(block_bytes), _BLOCKS), "blocks")
    # Sort the distinct blocks; a run of equal contents takes its smallest local number as name.
    named = (blocks.where(F.col("block").isNotNull())
             .select("local", F.min("local").over(Window.partitionBy("block")).alias("name")))
    named = stage(named, "block-names")
    seq = (blocks.select("rid", "block_no", "local", F.col("n_blocks").alias("left_over"))
           .join(named, "local").select("rid", "block_no", "name", "left_over"))
    longest = blocks.agg(F.max("n_blocks")).first()[0] or 1
    rounds, done = 0, []
    while True:
        seq = stage(seq, "block-seq") if longest > 1 else seq
        done.append(seq.where("left_over = 1").select("rid", F.lit(rounds).alias("rounds"), "name"))
        if longest == 1:
            break
        seq, longest, rounds = _name_pairs(seq.where("left_over > 1")), (longest + 1) // 2, rounds + 1
    identity = done[0]
    for d in done[1:]:
        identity = identity.unionByName(d)
    heads = blocks.where("block_no = 0").select("rid", "doc_id", "sha")
    return stage(heads.join(identity, "rid"), "doc-names")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    named = document_names(docs, block_bytes)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    # Staged, so that the join below reshuffles both sides and a hot identity can be split.
    groups = stage(named.groupBy("rounds", "name").agg(first, F.count("*").alias("group_size")), "doc-groups")
    return (named.join(groups, ["rounds", "name"])
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("first.rid")).alias("kept"), F.col("sha").alias("text_sha256")))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one per distinct normalised text."""
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    rows = packed(docs, id=F.col("doc_id"), sha=sha)
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")))
    return one_of_each(rows, "id", "sha").select("row.*")
