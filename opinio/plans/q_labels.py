"""Queries over the native labels of the full document table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.text import join_topics
from opinio.operators import labelers, merge, topics
from opinio.plans.registry import query
from opinio.session import stage
from opinio.sources import fixtures, tables


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, sentiment, topics_arr) for every document, one narrow pass."""
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    lab = labelers.label_posts(d, fixtures.lexicon(spark), fixtures.taxonomy(spark), "text")
    return lab.select("doc_id", "sentiment", "topics_arr")


def document_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged label table of the documents: topics as the stored ", " string."""
    lab = labelled_documents(spark, sf_dir)
    return lab.select("doc_id", join_topics(F.col("topics_arr")).alias("topics"), "sentiment")


def document_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.topic_mentions(document_merged(spark, sf_dir))


@query("topic_sentiment")
def q_topic_sentiment(spark, sf_dir):
    return merge.topic_sentiment_counts(document_mentions(spark, sf_dir))


@query("topic_sentiment_ranked")
def q_topic_sentiment_ranked(spark, sf_dir):
    return merge.rank_by_total(q_topic_sentiment(spark, sf_dir))


@query("sentiment_lexicon")
def q_sentiment_lexicon(spark, sf_dir):
    return labelled_documents(spark, sf_dir).select("doc_id", "sentiment")


@query("topics_taxonomy")
def q_topics_taxonomy(spark, sf_dir):
    return labelled_documents(spark, sf_dir).select("doc_id", join_topics(F.col("topics_arr")).alias("topics"))


@query("sentiment_share")
def q_sentiment_share(spark, sf_dir):
    """Sentiment counts and their share of all labelled documents."""
    counts = stage(labelled_documents(spark, sf_dir).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n")), "sentiments")
    total = counts.select(F.sum("n")).scalar()
    return counts.select("sentiment", "n", F.round(F.col("n") / total, 6).alias("share"))


@query("topic_share")
def q_topic_share(spark, sf_dir):
    """Mentions per topic, share of posts and share of mentions."""
    return topics.topic_share(labelled_documents(spark, sf_dir))


@query("topic_rollup")
def q_topic_rollup(spark, sf_dir):
    """rollup(topic, sentiment) with grouping id and share of the grand total."""
    return topics.topic_rollup(document_mentions(spark, sf_dir))


@query("topics_supported")
def q_topics_supported(spark, sf_dir):
    """Topics mentioned by at least 10% of posts, minus a stop list."""
    return topics.topics_supported(labelled_documents(spark, sf_dir), fixtures.stop_topics(spark), min_share=0.1)
