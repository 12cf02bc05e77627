"""Keyword clusters (G14): a term graph weighted by pointwise mutual information, and its strongest-link trees.

Neighbouring tokens of a text make a pair, so the pairs of a text grow with its length and not with the square of it. Every
keyword points along its strongest link; as links have one total order, the pointers end in pairs that point at each
other, and the terms that end in one pair are a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import tokens
from opinio.session import stage


def pair_counts(df: DataFrame, text_col: str, least: int) -> DataFrame:
    """(a, b, n): occurrences of each term (b is NULL) and of each pair of different neighbouring terms, a < b.

    One scan and one partially aggregated exchange on one string, as terms hold letters only: a hot term costs one
    row per map task. Pairs seen fewer than ``least`` times end there; terms stay, for they make up the total.
    """
    t = F.col("t")
    after = F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0)))
    near = (df.select(tokens(F.col(text_col)).alias("t")).where(t.isNotNull()).select("t", after.alias("after"))
            .select(F.explode(F.arrays_zip("t", "after")).alias("p")).select(F.col("p.t").alias("x"), F.col("p.after").alias("y")))
    pair = F.when(F.col("x") != F.col("y"), F.concat_ws(" ", F.least("x", "y"), F.greatest("x", "y")))
    counts = (near.select(F.explode(F.array("x", pair)).alias("key")).where("key is not null")
              .groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    key = F.split("key", " ")
    return counts.select(key[0].alias("a"), F.get(key, F.lit(1)).alias("b"), "n").where(F.col("b").isNull() | (F.col("n") >= least))


def strongest_links(counts: DataFrame, least: int) -> DataFrame:
    """(term, neighbour, lift) of every keyword with a link: seen together ``least`` times or more, and more often than by chance.

    Lift is the ratio whose logarithm is the mutual information. Ties: more often together, then the smaller pair.
    """
    terms = counts.where(F.col("b").isNull() & (F.col("n") >= least)).select(F.col("a").alias("term"), F.col("n").alias("n_term"))
    total = counts.where(F.col("b").isNull()).select(F.sum("n")).scalar()
    pairs = counts.where(F.col("b").isNotNull())
    left, right = terms.toDF("a", "n_a"), terms.toDF("b", "n_b")
    lift = (F.col("n") * total).cast("double") / (F.col("n_a") * F.col("n_b")).cast("double")
    links = pairs.join(left, "a").join(right, "b").withColumn("lift", lift).where("lift > 1")
    rank = F.struct((-F.col("lift")).alias("lift"), (-F.col("n")).alias("n"), "a", "b")
    ends = links.select(F.explode(F.array("a", "b")).alias("term"), rank.alias("link"))
    best = ends.groupBy("term").agg(F.min("link").alias("link"))
    return best.select("term", F.when(F.col("term") == F.col("link.a"), F.col("link.b")).otherwise(F.col("link.a")).alias("neighbour"),
                       (-F.col("link.lift")).alias("lift"))


def ends_of(links: DataFrame) -> DataFrame:
    """(term, cluster): the smaller term of the pair in which each term's pointers end; every round halves the ways."""
    back = links.select(F.col("term").alias("neighbour"), F.col("neighbour").alias("back"))
    mutual = F.col("back") == F.col("term")
    at = stage(links.join(back, "neighbour").select(
        "term", F.when(mutual, F.least("term", "neighbour")).otherwise(F.col("neighbour")).alias("cluster")), "keyword-ends")
    while True:
        further = at.select(F.col("term").alias("cluster"), F.col("cluster").alias("next"))
        moved = stage(at.join(further, "cluster").select(
            "term", F.col("next").alias("cluster"), (F.col("next") != F.col("cluster")).alias("moved")), "keyword-ends")
        at = moved.select("term", "cluster")
        if moved.where("moved").isEmpty():
            return at


def keyword_clusters(df: DataFrame, text_col: str, least: int = 3) -> DataFrame:
    """One row per term with ``least`` occurrences or more: term, n, cluster, size, neighbour, weight.

    ``cluster`` is named by one of its terms, ``size`` counts them; ``neighbour`` and ``weight`` (mutual information, natural
    logarithm) are those of the strongest link. A term without a link is a cluster of its own, with NULLs there. NULL
    and empty texts have no terms.
    """
    counts = stage(pair_counts(df, text_col, least), "keyword-pairs")
    links = stage(strongest_links(counts, least), "keyword-links")
    placed = links.join(ends_of(links), "term")
    terms = counts.where(F.col("b").isNull() & (F.col("n") >= least)).select(F.col("a").alias("term"), "n")
    rows = stage(terms.join(placed, "term", "left").select(
        "term", "n", F.coalesce("cluster", "term").alias("cluster"), "neighbour", F.round(F.log("lift"), 6).alias("weight")), "keywords")
    sizes = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return rows.join(sizes, "cluster").select("term", "n", "cluster", "size", "neighbour", "weight")
