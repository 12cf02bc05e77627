"""Mixing sources to target weights (operator 2): a low-discrepancy source schedule.

Slot i of the mix gets the point frac(i * golden ratio), in integers of 72 bits (golden up to some 2^36 slots). The source whose
interval of cumulative targets holds the point fills the slot. Slots are ranked per source, the
documents of each source are put in a shuffled order and cut into blocks of equally many words, and the
k-th slot of a source takes the k-th block of that source (its order repeats, at most three times).
A stretch of n slots holds each source within about log(n) slots of its share, so the mix is even
throughout; at every size a block is small enough for the smallest positive target to fill ``LEAST_BLOCKS`` of them, so
every source ends near its target. A source with one n-th of all words asks for ``LEAST_BLOCKS`` * n slots, one per word at most.

Weights go 5, 2, 1 and again through the sources in code-point order, NULL last. A target stops at three
times the size of its source and the rest is shared again by weight until none is above.

Scale. Texts are read once for their sizes; all else moves a few numbers per document and per slot.
Sources are a dimension (one row each); a source with a third of all rows is cut into buckets of its
shuffled order, whose sums give the offsets, so no window holds a whole source. Ranks of slots are
numbered the same way, in ranges of slots. Slots find their source by an equi-join on 4096 cells. Repeated rows
are counted before anything is ordered and stand side by side, so they make no bucket hot. The small tables per source
are staged before they are joined: Spark sees their size and does not deal the documents by source.

Defined results. NULL and empty texts have size 0 and are never taken. Repeated rows and rows without an id are
mixed as rows of their own. An empty table gives an empty result. Reruns agree, in whatever order the rows are read: the
order is that of md5 over the id and the text's md5. Only id, source and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import RowIds, none_if_missing, one_of_each, packed, stage, words

WEIGHTS = (5, 2, 1)
MAX_TIMES = 3
#: Words of a block at most; blocks that the smallest positive target fills at least.
BLOCK_WORDS = 1024
LEAST_BLOCKS = 256
#: Rows of a bucket of a source's shuffled order, on average; slots of a range.
BUCKET_ROWS, RANGE_SLOTS = 4096, 4096
_LIMB, _CELL_BITS = 24, 12
# 2^72 / golden ratio, odd, in three limbs of 24 bits, the lowest first: the golden ratio's digits by its own recurrence,
# a ratio of neighbouring Fibonacci numbers that is exact far beyond 72 bits.


def _golden_limbs() -> tuple[int, int, int]:
    a, b = 0, 1
    while b < 1 << 80:
        a, b = b, a + b
    step = (a << 3 * _LIMB) // b | 1
    return tuple(step >> k * _LIMB & (1 << _LIMB) - 1 for k in range(3))


_STEP = _golden_limbs()

_MEASURED = "rid long, doc_id long, source string, size long, text_key string"


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids = RowIds()
    for pdf in batches:
        texts = [none_if_missing(t) for t in pdf["text"]]
        first = ids.take(len(pdf))
        yield pd.DataFrame({
            "rid": range(first, first + len(pdf)), "doc_id": pdf["doc_id"].astype("Int64").to_numpy(),
            "source": pdf["source"].to_numpy(), "size": [len(words(t)) for t in texts],
            "text_key": [None if t is None else hashlib.md5(t.encode()).hexdigest() for t in texts]})


@dataclass
class Mixture:
    sources: DataFrame   # number, source, source_size, target
    schedule: DataFrame  # slot, number (of the source), block (of that source's shuffled order)
    documents: DataFrame  # rid, doc_id, text_key, size, source_size, target, taken
    block_words: int


def _targets(sources: DataFrame) -> tuple[DataFrame, int]:
    """Add weight, target and the interval [low, high) of cumulative targets; the total number of words."""
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("number") % len(WEIGHTS) + 1)
    sources = stage(sources.withColumn("number", number).withColumn("weight", weight.cast("long")), "sources")
    total, weights, n = sources.agg(F.sum("source_size"), F.sum("weight"), F.count("*")).first()
    if not n:
        total, weights = 0, 1
    cap, level = MAX_TIMES * F.col("source_size"), total / weights
    while True:  # each round shares what the capped sources leave; the level only rises
        full = cap < F.lit(level) * F.col("weight")
        used, rest = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        new = (total - (used or 0)) / rest if rest else level
        if new == level:
            break
        level = new
    so_far = Window.orderBy("number")
    full_sum = F.sum(F.when(full, cap).otherwise(0)).over(so_far)
    weight_sum = F.sum(F.when(full, 0).otherwise(F.col("weight"))).over(so_far)
    high = full_sum.cast("double") + F.lit(float(level)) * weight_sum
    sources = (sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(F.lit(float(level)) * F.col("weight")))
               .withColumn("high", high))
    low = F.lag("high", 1, 0.0).over(so_far)
    last = F.col("number") == (n or 1) - 1
    return sources.withColumn("low", low).withColumn("high", F.when(last, 2.0 * total).otherwise(F.col("high"))), total


def _schedule(sources: DataFrame, slots: int, total: int) -> DataFrame:
    """slot, number, block: the golden-ratio points through the cumulative targets, ranked per source."""
    whole, cells, limb = 1 << 2 * _LIMB, 1 << _CELL_BITS, F.lit(1 << _LIMB)
    low, high = F.col("id") % limb, F.shiftright("id", _LIMB)
    # id * step modulo 2^72, limb by limb; the two upper limbs are the point
    first = F.shiftright(low * _STEP[0], _LIMB) + low * _STEP[1] + high * _STEP[0]
    second = F.shiftright(first, _LIMB) + low * _STEP[2] + high * _STEP[1]
    points = (sources.sparkSession.range(slots)
              .select(F.col("id").alias("slot"), ((second % limb) * limb + first % limb).alias("point"))
              .select("slot", ((F.col("point") + 0.5) / whole * total).alias("x"),
                      F.shiftright("point", 2 * _LIMB - _CELL_BITS).cast("int").alias("cell")))
    scale = F.lit(cells / max(total, 1))
    first = F.greatest(F.lit(0), F.floor(F.col("low") * scale).cast("int") - 1)
    final = F.least(F.lit(cells - 1), F.floor(F.col("high") * scale).cast("int") + 1)
    spans = (sources.where("high > low").withColumn("first", first).withColumn("final", final).where("first <= final")
             .select("number", "low", "high", F.explode(F.sequence("first", "final")).alias("cell")))
    held = stage(points.join(spans, "cell").where("x >= low and x < high")
                 .select("slot", "number", F.expr(f"slot div {RANGE_SLOTS}").alias("range")), "slots")
    counts = held.groupBy("number", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.select("number", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                    "slot-offsets")
    place = F.row_number().over(Window.partitionBy("number", "range").orderBy("slot")) - 1
    return (held.withColumn("place", place).join(offsets, ["number", "range"])
            .select("slot", "number", (F.col("before") + F.col("place")).alias("block")))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> Mixture:
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                      F.col("text").cast("string").alias("text"))
    rows = stage(src.mapInPandas(_measure, _MEASURED), "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources, total = _targets(totals)
    sources = stage(sources, "targets")
    least = sources.where("target > 0").agg(F.min("target")).first()[0] or 0
    block = max(1, min(block_words, int(least) // LEAST_BLOCKS))
    schedule = stage(_schedule(sources, -(-total // block), total), "schedule")

    # Shuffled order of each source, as offsets of its documents: bucket sums, then sums within a bucket.
    same = stage(rows.groupBy("doc_id", "source", "size", "text_key").agg(F.count("*").alias("copies"), F.min("rid").alias("rid")), "rows")
    buckets = max(1, -(-same.count() // BUCKET_ROWS))
    order = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                           F.coalesce("text_key", F.lit(""))))
    high32 = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    named = (same.join(sources.select("source", "number", "source_size", "target"),
                       same["source"].eqNullSafe(sources["source"])).drop("source")
             .withColumn("order", order).withColumn("bucket", F.shiftright(high32 * buckets, 32)))
    named = stage(named.withColumn("words", F.col("size") * F.col("copies")), "ordered")
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(named.groupBy("number", "bucket").agg(F.sum("words").alias("n"))
                    .select("number", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                    "bucket-offsets")
    inside = (Window.partitionBy("number", "bucket").orderBy("order", F.col("doc_id").asc_nulls_last(), "text_key")
              .rowsBetween(Window.unboundedPreceding, -1))
    named = named.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    placed = stage(named.join(offsets, ["number", "bucket"]).withColumn("copy", copy)
                   .withColumn("start", F.col("before") + F.col("inside") + F.col("copy") * F.col("size"))
                   .drop("before", "inside", "order", "bucket", "words", "copies"), "placed")

    # The words of each document in each block of its source's repeated order.
    limits = stage(schedule.groupBy("number").agg((F.count("*") * block).alias("limit")), "limits")
    at = F.col("start") + F.col("time") * F.col("source_size")
    cut = (placed.where("size > 0").join(limits, "number")
           .withColumn("time", F.explode(F.sequence(F.lit(0), F.lit(MAX_TIMES - 1)))).withColumn("from", at)
           .where(F.col("from") < F.col("limit")).withColumn("to", F.col("from") + F.col("size"))
           .withColumn("block", F.explode(F.sequence(F.expr(f"`from` div {block}"), F.expr(f"(`to` - 1) div {block}"))))
           .select("rid", "copy", "number", "block",
                   (F.least(F.col("to"), (F.col("block") + 1) * block) - F.greatest(F.col("from"), F.col("block") * block))
                   .alias("words")))
    taken = cut.join(schedule, ["number", "block"]).groupBy("rid", "copy").agg(F.sum("words").alias("taken"))
    result = (placed.join(taken, ["rid", "copy"], "left")
              .select("rid", "doc_id", "text_key", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    return Mixture(sources, schedule, result, block)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as whole documents, all columns of ``docs``: each row as often as the mix takes it.

    A source's last document is taken in part; it counts when at least half of it is taken.
    """
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = (mix(docs).documents.where("taken > 0").select(F.col("doc_id").alias("taken_id"),
                                                           F.col("text_key").alias("taken_key"), times.alias("times"))
             .groupBy("taken_id", "taken_key").agg(F.sum("times").cast("int").alias("times")).where("times > 0"))
    rows = packed(docs, id=F.col("doc_id"), key=F.md5(F.col("text").cast("string")))
    rows = rows.join(taken, F.col("id").eqNullSafe(F.col("taken_id")) & (F.col("key") == F.col("taken_key")))
    return (one_of_each(rows, "id", "key")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*"))
