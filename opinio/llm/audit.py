"""Filter interaction audit (operator 12): forward-backward path counting over the lattice of filter subsets.

Every document has a mask: the filters that it fails. A state is the set S of filters already applied, an edge
S -> S + f applies one more; a document leaves along the edges that apply one of its failed filters while it has
none of them behind it. With the documents counted by mask, one sum over masks gives what every edge removes.
The number of orders that reach a state comes from a forward count over the edges, the number that leave it
from a backward count; the orders through an edge are the product of both ends, and weight its removals for the
filter's Shapley sum. Each order is a path, so its steps are read from the same edges: k filters need k * 2^(k-1)
edges, not k! * k scans.

Scale. Texts are read once, by built-in functions; what goes on is a digest, four bits and an id per document.
Copies of a text are told from its first document by the smallest id per digest (partially aggregated) and a
join on (digest, id), which spreads even a text that a third of all rows share; rows equal in all of this are
counted before they are joined. Labels meet (id, part, mask) counts, a few rows per id. Each part ends as one
small group: at most 4 * 2^k rows, whatever the size of the corpus.

Defined results. NULL text is the empty text: no words, so it fails A, and neither B, C nor D. E compares whole texts
by a 256-bit digest; a NULL doc_id is no smaller than any other, and has no smaller one, and rows of equal id and text
do not remove each other. A document counts as good (toxic) when any label row of its id has quality = 1 (toxic = 1);
NULL ids have no labels. A NULL lang is the part ''. Repeated rows count each. Without documents the result is empty.
Only doc_id, text, lang and the three label columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import stage

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a whole, non-null text and its words (the filters A to D)."""
    n = F.size(words)
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _bits(failed: list[Column]) -> Column:
    """One bit per condition, the first the lowest."""
    bits = F.lit(0)
    for k, fails in enumerate(failed):
        bits = bits + F.when(fails, 1 << k).otherwise(0)
    return bits


def masked(docs: DataFrame) -> tuple[DataFrame, str]:
    """(id, part, mask, n): documents by what they fail, and the letters of the mask's bits, the lowest first."""
    src = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("words", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    failed = text_filters(F.col("text"), F.col("words"))
    read = stage(src.select("id", "part", F.unhex(F.sha2("text", 256)).alias("key"), _bits(list(failed.values())).alias("mask")),
                 "text-filters")
    first = read.groupBy("key").agg(F.min("id").alias("id"), F.lit(True).alias("first"))
    counted = read.groupBy("key", "id", "part", "mask").agg(F.count("*").alias("n"))
    # An id is either the smallest of its text or larger; a NULL id joins nothing and is neither.
    found = counted.join(first.where("id is not null"), ["key", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(copy, 1 << len(failed)).otherwise(0)
    return found.withColumn("mask", mask).groupBy("id", "part", "mask").agg(F.sum("n").alias("n")), "".join(failed) + "E"


def labelled(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and the good and the toxic ones among them."""
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), "quality", "toxic").where("id is not null")
             .groupBy("id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    with_id = counts.where("id is not null").join(known, "id", "left").select("part", "mask", "n", "good", "toxic")
    none = F.lit(None).cast("int")
    without = counts.where("id is null").select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    sums = [F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
    return with_id.unionByName(without).groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)


class Lattice:
    """Subsets of k filters as bit masks; the paths through them."""

    def __init__(self, k: int) -> None:
        self.k, self.full = k, (1 << k) - 1
        self.forward = np.zeros(1 << k, dtype=np.int64)   # orders that reach a state
        self.backward = np.zeros(1 << k, dtype=np.int64)  # orders that leave it
        self.forward[0] = self.backward[self.full] = 1
        for s in range(1 << k):  # every edge goes to a larger number
            for f in self.leaving(s):
                self.forward[s | 1 << f] += self.forward[s]
        for s in range(self.full, -1, -1):
            for f in self.leaving(s):
                self.backward[s] += self.backward[s | 1 << f]

    def leaving(self, state: int) -> Iterator[int]:
        return (f for f in range(self.k) if not state >> f & 1)

    def edges(self) -> Iterator[tuple[int, int]]:
        return ((s, f) for s in range(self.full) for f in self.leaving(s))

    def through(self, state: int, f: int) -> int:
        """Orders that go along an edge."""
        return int(self.forward[state] * self.backward[state | 1 << f])


def report(part: str, counts: np.ndarray, letters: str) -> Iterator[tuple]:
    """Rows of ``REPORT`` for one part; counts: [mask, (all, good, toxic)]."""
    lattice, masks = Lattice(len(letters)), np.arange(1 << len(letters))
    left = np.array([counts[masks & s == 0].sum(axis=0) for s in masks])  # what a state has kept
    removed = {(s, f): left[s] - left[s | 1 << f] for s, f in lattice.edges()}
    fails = [int(counts[masks >> f & 1 == 1, 0].sum()) for f in range(lattice.k)]
    shapley = [sum(lattice.through(s, f) * int(removed[s, f][0]) for s, f in removed if f == g) for g in range(lattice.k)]
    for order in itertools.permutations(range(lattice.k)):
        state = 0
        for step, f in enumerate(order, 1):
            gone = removed[state, f].tolist()
            state |= 1 << f
            yield (part, "".join(letters[g] for g in order), step, int(left[state, 0]), gone[0], fails[f] - gone[0],
                   int(counts[1 << f, 0]), gone[1], gone[2], shapley[f])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    counts, letters = masked(docs)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((1 << len(letters), 3), dtype=np.int64)
        table[group["mask"].to_numpy()] = group[["n", "good", "toxic"]].to_numpy()
        return pd.DataFrame(report(key[0], table, letters), columns=[c.split()[0] for c in REPORT.split(", ")])

    return labelled(counts, labels).groupBy("part").applyInPandas(run, REPORT)
