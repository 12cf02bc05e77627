"""Frequency, spikes, conversation prefixes and the learned models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.sql import functions as F

from opinio.functions.feedtime import ts_text
from opinio.functions.text import LETTERS
from opinio.operators import keywords, learned, topics
from opinio.operators.conversations import conversation_history
from opinio.plans.registry import query
from opinio.sources import fixtures, tables

# The system message that opens every conversation (ours).
SYSTEM_MESSAGE = "Extract the event keywords, start date and platform of the request as JSON."


@query("term_frequency")
def q_term_frequency(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "text")
    return topics.term_frequency(d, "text")


@query("negative_spikes")
def q_negative_spikes(spark, sf_dir):
    """Hourly negative mentions per topic over the labelled posts, 3 sigma over the last 24 hours."""
    p = fixtures.labelled_posts(spark, sf_dir)
    m = p.select(F.explode("topics_arr").alias("topic"),
                 F.date_trunc("hour", F.col("posted_at")).cast("timestamp_ntz").alias("hour"), "sentiment")
    s = topics.negative_spikes(m, k=3.0, lookback=24)
    return s.withColumn("hour", ts_text(F.col("hour")))


@query("conversation_prefix")
def q_conversation_prefix(spark, sf_dir):
    """The messages of every conversation, the system message first, and what each call sends."""
    return conversation_history(tables.conversations(spark, sf_dir, "conv_id", "turn", "role", "text"), SYSTEM_MESSAGE)


@query("term_clusters")
def q_term_clusters(spark, sf_dir):
    """Keyword clustering - tokens -> hashed term counts -> IDF -> k-means (k=8)."""
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern=LETTERS, gaps=False, toLowercase=True),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1 << 14),
        IDF(inputCol="tf", outputCol="features"),
        KMeans(featuresCol="features", predictionCol="cluster", k=8, seed=7, maxIter=10),
    ])
    model = pipe.fit(d)
    return model.transform(d).select("doc_id", F.col("cluster").cast("int").alias("cluster"))


@query("keyword_clusters")
def q_keyword_clusters(spark, sf_dir):
    """Every keyword of the documents with its cluster in the graph of neighbouring terms."""
    return keywords.keyword_clusters(tables.documents(spark, sf_dir, "text"), "text")


@query("sentiment_model")
def q_sentiment_model(spark, sf_dir):
    """M6: a learned stand-in labeler for three sentiments, trained on ``labels`` (toxic: negative, good: positive,
    else neutral). A fifth of the ids, by CRC, is held out and never trained on; ``actual`` is the label where there is one."""
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    lab = tables.labels(spark, sf_dir, "doc_id", "quality", "toxic")
    actual = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    rows = (d.join(lab.select("doc_id", actual.alias("actual")).dropDuplicates(["doc_id"]), "doc_id", "left")
            .withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0))
    return learned.predict(learned.fit(rows.where(~F.col("held_out") & F.col("actual").isNotNull()), "text", "actual"), rows, "text").select(
        "doc_id", "held_out", "actual", "sentiment", *[F.round(f"p_{s}", 6).alias(f"p_{s}") for s in learned.CLASSES])
