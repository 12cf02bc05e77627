"""Per-event report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinio.operators import feed, replies, report, request_ops
from opinio.plans.registry import query
from opinio.session import stage
from opinio.sources import fixtures


def _events(spark, sf_dir):
    v = request_ops.validate_requests(fixtures.requests(spark, sf_dir), days=F.col("request_id") % 2 + 1)
    return stage(v.where(F.col("status") == "ok"), "requests")  # parsed once


def _event_posts(spark, sf_dir, events):
    """(request_id, post_id, sentiment, topics_arr): labelled posts of every event."""
    posts = fixtures.labelled_posts(spark, sf_dir).select("post_id", "posted_at", "body", "sentiment", "topics_arr")
    return feed.posts_for_requests(posts, events).select("request_id", "post_id", "sentiment", "topics_arr")


def _summary(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return report.event_summary(ev, report.event_rows(_event_posts(spark, sf_dir, ev)))


@query("sentiment_report_input")
def q_sentiment_report_input(spark, sf_dir):
    return report.sentiment_report_input(_summary(spark, sf_dir))


@query("topic_report_input")
def q_topic_report_input(spark, sf_dir):
    return report.topic_report_input(_summary(spark, sf_dir))


@query("sentiment_report_text")
def q_sentiment_report_text(spark, sf_dir):
    return report.sentiment_report_text(_summary(spark, sf_dir))


@query("topic_report_text")
def q_topic_report_text(spark, sf_dir):
    return report.topic_report_text(_summary(spark, sf_dir))


@query("table_as_text")
def q_table_as_text(spark, sf_dir):
    return report.table_as_text(_summary(spark, sf_dir))


@query("event_report_input")
def q_event_report_input(spark, sf_dir):
    return report.event_report_input(_summary(spark, sf_dir))


@query("event_report_sections")
def q_event_report_sections(spark, sf_dir):
    """J8 with summaries missing in turn (one event in four lacks each)."""
    s = stage(_summary(spark, sf_dir), "event-summary")

    def without(name, df, k):
        return stage(df, name).where(F.col("request_id") % 4 != k)

    return report.event_report(s, without("sentiment-texts", report.sentiment_report_text(s), 1),
                               without("topic-texts", report.topic_report_text(s), 2),
                               without("table-texts", report.table_as_text(s), 3))


def _run_replies(spark, sf_dir):
    return replies.parse_replies(fixtures.replies(fixtures.entry_rows(spark, sf_dir).rows))


@query("run_sentiment_report_input")
def q_run_sentiment_report_input(spark, sf_dir):
    """F15 on G3: a run's totals as its replies report them."""
    totals = replies.totals_reported(_run_replies(spark, sf_dir), "run_id")
    return report.sentiment_report_input(totals.withColumn("event_keyword", F.lit(fixtures.PAGE_KEYWORD)), "run_id")


@query("run_topic_report_input")
def q_run_topic_report_input(spark, sf_dir):
    """F16 on G6: a run's topics with their number of mentions, in first-seen order."""
    m = replies.topic_mentions_all(_run_replies(spark, sf_dir))
    rows = m.groupBy("run_id", "topic").agg(F.count(F.lit(1)).alias("n"),
                                            F.min(F.struct("chunk_id", "entry_idx", "topic_pos")).alias("first"))
    runs = rows.groupBy("run_id").agg(F.collect_list(F.struct("first", "topic", "n")).alias("tr"))
    return report.topic_report_input(runs.withColumn("event_keyword", F.lit(fixtures.PAGE_KEYWORD)), "run_id")
