"""Merging the two label sets and counting topic x sentiment.

``merge_labels`` keeps the source program's join semantics (left join on
(entry_no, body), missing keys match each other, repeated keys multiply) without
emitting the pairs: the sentiment side is first reduced to one row per
(key, sentiment) with its multiplicity ``n``, so a hot key costs one row per
distinct sentiment instead of |left| x |right| rows. Downstream counts sum ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import split_topics, utrim
from opinio.operators.labelers import SENTIMENTS
from opinio.operators.numbering import global_row_number
from opinio.session import stage


def _key(df: DataFrame, name: str) -> Column:
    """A key column; texts as a digest, so that whole bodies are neither shuffled nor sorted as keys."""
    return F.sha2(F.col(name), 256) if df.schema[name].dataType.simpleString() == "string" else F.col(name)


def merge_labels(topic: DataFrame, sentiment: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Topic LEFT JOIN sentiment ON null-safe keys -> (keys..., topics, sentiment, n).

    ``keys`` default to the first two columns of ``topic`` (P12, positional);
    the sentiment value is the third column of ``sentiment``.
    """
    keys = keys or topic.columns[:2]
    value = sentiment.columns[2]
    s = (sentiment.select(*[_key(sentiment, k).alias(f"_s_{k}") for k in keys], F.col(value).alias("sentiment"))
         .groupBy(*[f"_s_{k}" for k in keys], "sentiment").agg(F.count(F.lit(1)).alias("n")))
    t = topic.select("*", *[_key(topic, k).alias(f"_t_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & t[f"_t_{k}"].eqNullSafe(s[f"_s_{k}"])
    j = t.join(s, cond, "left")
    return j.select(*topic.columns, "sentiment", F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("n"))


def merge_labels_strict(topic: DataFrame, sentiment: DataFrame,
                        keys: tuple[str, ...] = ("run_id", "chunk_id", "entry_no")) -> DataFrame:
    """J1 on the chunk key: one sentiment per entry, no multiplication."""
    s = sentiment.select(*keys, "sentiment")
    return topic.join(s, list(keys), "left")


def clean_merged(merged: DataFrame, topics_col: str = "topics") -> DataFrame:
    """P10 + P11: drop body / entry number, keep rows whose topics are not blank."""
    return (merged.drop("body", "entry_no")
            .where(F.col(topics_col).isNotNull() & (utrim(F.col(topics_col)) != F.lit(""))))


def topic_mentions(merged: DataFrame, topics_col: str = "topics") -> DataFrame:
    """one row per topic mention (topic, sentiment, n)."""
    n = F.col("n") if "n" in merged.columns else F.lit(1).cast("long")
    return merged.select(F.explode(split_topics(F.col(topics_col))).alias("topic"),
                         utrim(F.col("sentiment")).alias("sentiment"), n.alias("n"))


def topic_sentiment_counts(mentions: DataFrame) -> DataFrame:
    """G1 + G2: per topic, mentions by known sentiment; total = neg + neu + pos.

    Unknown or NULL sentiment adds nothing, but the topic row stays (zeros).
    Partial aggregation runs before the shuffle, so a hot topic costs one row per
    map task in the exchange.
    """
    n = F.col("n") if "n" in mentions.columns else F.lit(1)
    sums = [F.sum(F.when(F.col("sentiment") == s, n).otherwise(0)).cast("long").alias(s) for s in SENTIMENTS]
    g = mentions.groupBy("topic").agg(*sums)
    return g.withColumn("total", F.col("negative") + F.col("neutral") + F.col("positive"))


def rank_by_total(ts: DataFrame) -> DataFrame:
    """O1: rank 1.. by total descending, ties by topic (the tie rule is ours).

    The counts are staged first: numbering reads its input several times, the rows behind the counts are read once.
    """
    ranked = global_row_number(stage(ts, "topic-counts"), [F.col("total").desc(), F.col("topic").asc()], "_r")
    return ranked.withColumn("rank", (F.col("_r") + 1).cast("long")).drop("_r")
