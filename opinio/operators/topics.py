"""Topic statistics.

Totals that every row needs (number of posts, number of mentions) come from the grouped
counts themselves: these are staged (one row per topic) and a scalar subquery sums them, so the
posts are labelled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.text import tokens
from opinio.session import stage


def topic_share(topics: DataFrame, arr: str = "topics_arr") -> DataFrame:
    """(topic, n, share_posts, share_mentions) of rows with a topics array, in one pass.

    Every post adds one row without a topic, so the grouped counts hold both totals; they are staged (one
    row per topic) and the totals read from there.
    """
    rows = topics.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col(arr))).alias("topic"))
    counts = stage(rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n")), "topic-counts")
    n_posts = counts.where("topic is null").select(F.sum("n")).scalar()
    n_mentions = counts.where("topic is not null").select(F.sum("n")).scalar()
    return counts.where("topic is not null").select("topic", "n",
                                                    F.round(F.col("n") / n_posts, 6).alias("share_posts"),
                                                    F.round(F.col("n") / n_mentions, 6).alias("share_mentions"))


def topic_rollup(mentions: DataFrame) -> DataFrame:
    """rollup(topic, sentiment) of mention weights, grouping id, share of the total (the rollup's last row)."""
    w = F.col("n") if "n" in mentions.columns else F.lit(1)
    r = stage(mentions.rollup("topic", "sentiment").agg(F.sum(w).cast("long").alias("n"),
                                                        F.grouping_id().cast("int").alias("gid")), "topic-rollup")
    total = r.where("gid = 3").select(F.sum("n")).scalar()
    return r.select("topic", "sentiment", "gid", "n", F.round(F.col("n") / total, 6).alias("share"))


def topics_supported(topics: DataFrame, stop: DataFrame, min_share: float, arr: str = "topics_arr") -> DataFrame:
    """Topics mentioned by at least ``min_share`` of the posts, minus a stop list (anti join); one pass."""
    rows = topics.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col(arr))).alias("topic"))
    counts = stage(rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n")), "topic-counts")
    n_posts = counts.where("topic is null").select(F.sum("n")).scalar()
    kept = counts.where(F.col("topic").isNotNull() & (F.col("n") >= F.lit(min_share) * n_posts))
    return kept.join(stop.select("topic"), "topic", "left_anti")


def term_frequency(df: DataFrame, text_col: str) -> DataFrame:
    """Per term, occurrences (tf) and number of texts containing it (df).

    One explode of (term, 1, 0) for every token and (term, 0, 1) for every distinct token of a text, and one
    partially aggregated group-by on the term: one scan, one exchange, a hot term costs one row per map task.
    """
    t = tokens(F.col(text_col))

    def marked(arr, tf: int, df_: int):
        return F.transform(arr, lambda x: F.struct(x.alias("term"), F.lit(tf).alias("tf"), F.lit(df_).alias("df")))

    rows = (df.select(t.alias("t")).select(F.explode(F.concat(marked(F.col("t"), 1, 0), marked(F.array_distinct("t"), 0, 1)))
                                           .alias("x")).select("x.*"))
    return rows.groupBy("term").agg(F.sum("tf").cast("long").alias("tf"), F.sum("df").cast("long").alias("df"))


def negative_spikes(mentions: DataFrame, k: float = 3.0, lookback: int = 24) -> DataFrame:
    """Hours where a topic's negative count exceeds trailing mean + k * stddev.

    ``mentions``: (topic, hour timestamp_ntz, sentiment). Counts go on a dense
    hourly grid per topic (each topic from its first to its last hour, so no
    topic x hour cross join); trailing statistics over the previous ``lookback``
    hours of the same topic.
    """
    hourly = mentions.groupBy("topic", "hour").agg(
        F.count_if(F.col("sentiment") == "negative").alias("neg"))
    span = hourly.groupBy("topic").agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    grid = span.select("topic", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    dense = grid.join(hourly, ["topic", "hour"], "left").withColumn("neg", F.coalesce("neg", F.lit(0)).cast("long"))
    w = Window.partitionBy("topic").orderBy("hour").rowsBetween(-lookback, -1)
    stats = dense.withColumn("mean", F.avg("neg").over(w)).withColumn("sd", F.stddev_samp("neg").over(w))
    flagged = stats.where(F.col("neg") > F.col("mean") + F.lit(k) * F.col("sd"))
    return flagged.select("topic", "hour", "neg", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))
