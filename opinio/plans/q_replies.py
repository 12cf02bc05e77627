"""Queries over chunks, labeler replies and the merged label tables."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F

from opinio.operators import labelers, merge, replies
from opinio.plans.registry import query
from opinio.session import stage
from opinio.sources import fixtures


def _staged(spark, sf_dir):
    """(entries without bodies, parsed replies) over one staged entries table."""
    e = fixtures.entry_rows(spark, sf_dir).rows
    return e, replies.parse_replies(fixtures.replies(e))


def _parsed(spark, sf_dir):
    return _staged(spark, sf_dir)[1]


def _aligned(spark, sf_dir):
    """Both kinds aligned in one pass, staged, because the two label tables are read from it; no bodies in it."""
    e, parsed = _staged(spark, sf_dir)
    return stage(replies.align_labels(e, parsed, "body_key"), "aligned")


@query("chunks")
def q_chunks(spark, sf_dir):
    return fixtures.entry_numbers(spark, sf_dir)


@query("chunk_text")
def q_chunk_text(spark, sf_dir):
    return replies.chunk_text(fixtures.entries(spark, sf_dir))


@query("replies_parsed")
def q_replies_parsed(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.select("run_id", "chunk_id", "kind", "status",
                    F.coalesce(F.size("analyses"), F.lit(0)).cast("long").alias("n_analyses"),
                    F.col("sum_positive").cast("long").alias("sum_positive"),
                    F.col("sum_neutral").cast("long").alias("sum_neutral"),
                    F.col("sum_negative").cast("long").alias("sum_negative"))


@query("reply_clean")
def q_reply_clean(spark, sf_dir):
    return _parsed(spark, sf_dir).select("run_id", "chunk_id", "kind", "clean")


@query("replies_status")
def q_replies_status(spark, sf_dir):
    return _parsed(spark, sf_dir).select("run_id", "chunk_id", "kind", "status")


@query("labels_aligned")
def q_labels_aligned(spark, sf_dir):
    return _aligned(spark, sf_dir).select("run_id", "chunk_id", "entry_no", "post_id", "kind", "label")


@query("sentiment_totals_reported")
def q_totals_reported(spark, sf_dir):
    return replies.totals_reported(_parsed(spark, sf_dir))


@query("sentiment_totals_counted")
def q_totals_counted(spark, sf_dir):
    return replies.totals_counted(_aligned(spark, sf_dir))


@query("sentiment_reconcile")
def q_reconcile(spark, sf_dir):
    e, p = _staged(spark, sf_dir)
    return replies.reconcile(p, replies.align_labels(e, p, "body_key"))


@query("topic_counts")
def q_topic_counts(spark, sf_dir):
    return replies.topic_counts(_parsed(spark, sf_dir))


@query("topic_registry")
def q_topic_registry(spark, sf_dir):
    return replies.topic_registry(_parsed(spark, sf_dir))


@query("topics_visible")
def q_topics_visible(spark, sf_dir):
    e, p = _staged(spark, sf_dir)
    return replies.topics_visible(e, replies.topic_registry(p))


@query("chunk_prompts")
def q_chunk_prompts(spark, sf_dir):
    e = fixtures.entry_rows(spark, sf_dir)
    vis = replies.topics_visible(e.rows, replies.topic_registry(replies.parse_replies(fixtures.replies(e.rows))))
    return replies.chunk_prompts(replies.chunk_text(e.rows.join(e.bodies, "_row")), vis)


@query("topics_new")
def q_topics_new(spark, sf_dir):
    """Topics the replies introduced beyond the starting list (the taxonomy's topics)."""
    known = fixtures.taxonomy(spark).select("topic").distinct()
    return replies.topics_new(replies.topic_registry(_parsed(spark, sf_dir)), known)


@query("chunk_mismatch")
def q_chunk_mismatch(spark, sf_dir):
    return replies.chunk_mismatch(*_staged(spark, sf_dir))


@query("labels_known")
def q_labels_known(spark, sf_dir):
    """Aligned sentiment rows whose label is a known sentiment (semi join)."""
    s = replies.sentiment_table(_aligned(spark, sf_dir))
    return (s.join(fixtures.known_sentiments(spark), "sentiment", "left_semi")
            .select("run_id", "chunk_id", "entry_no", "post_id", "sentiment"))


def _label_keys(aligned):
    """The two label tables as the source program joins them, (entry_no, body, value), a digest for the body."""
    t = replies.topic_table(aligned).select("entry_no", "body_key", "topics", "run_id", "chunk_id")
    return t, replies.sentiment_table(aligned).select("entry_no", "body_key", "sentiment")


def _merged_keys(spark, sf_dir):
    return merge.merge_labels(*_label_keys(_aligned(spark, sf_dir))).drop("body_key", "run_id", "chunk_id")


@query("merged_labels")
def q_merged_labels(spark, sf_dir):
    """Merged on digests; the body comes in with the last join."""
    e = fixtures.entry_rows(spark, sf_dir)
    parsed = replies.parse_replies(fixtures.replies(e.rows))
    merged = merge.merge_labels(*_label_keys(stage(replies.align_labels(e.rows, parsed, "body_key"), "aligned")))
    rows = merged.join(e.rows.select("run_id", "chunk_id", "entry_no", "_row"), ["run_id", "chunk_id", "entry_no"])
    return rows.join(e.bodies, "_row").select("entry_no", "body", "topics", "sentiment", "n")


@query("merged_labels_strict")
def q_merged_labels_strict(spark, sf_dir):
    a = _aligned(spark, sf_dir)
    m = merge.merge_labels_strict(replies.topic_table(a), replies.sentiment_table(a))
    return m.select("run_id", "chunk_id", "entry_no", "post_id", "topics", "sentiment")


@query("merged_clean")
def q_merged_clean(spark, sf_dir):
    return merge.clean_merged(_merged_keys(spark, sf_dir))


@query("topic_mentions")
def q_topic_mentions(spark, sf_dir):
    return merge.topic_mentions(merge.clean_merged(_merged_keys(spark, sf_dir)))


@query("merged_topic_sentiment")
def q_merged_topic_sentiment(spark, sf_dir):
    """G1 over the reply path: merged label files -> topic x sentiment."""
    return merge.topic_sentiment_counts(merge.topic_mentions(merge.clean_merged(_merged_keys(spark, sf_dir))))


# The system text of each labelling task (ours).
SYSTEM_TEXTS = [
    ("sentiment", "Label each numbered entry as positive, neutral or negative; reply with JSON analyses and summary."),
    ("topic", "Name the public-impact topics of each numbered entry; reply with JSON analyses."),
]


@query("chunk_messages")
def q_chunk_messages(spark, sf_dir):
    """J7 + W5: every chunk gets a fresh two-message conversation per task."""
    e = fixtures.entry_rows(spark, sf_dir)
    text = stage(replies.chunk_text(e.rows.join(e.bodies, "_row")), "chunk-text")
    vis = replies.topics_visible(e.rows, replies.topic_registry(replies.parse_replies(fixtures.replies(e.rows))))
    prompts = replies.chunk_prompts(text, vis)
    user = (text.select("run_id", "chunk_id", F.lit("sentiment").alias("kind"), F.col("text").alias("user"))
            .unionByName(prompts.select("run_id", "chunk_id", F.lit("topic").alias("kind"), F.col("prompt").alias("user"))))
    system = spark.createDataFrame(SYSTEM_TEXTS, "kind string, system string")
    # two rows: a fixed-size dimension
    return user.join(F.broadcast(system), "kind").select(
        "run_id", "chunk_id", "kind", F.lit(2).cast("long").alias("n_messages"), "system", "user")


# ------------------------------------------------------------------- M5 labeler hook

def lexicon_reply_stub(lexicon: dict[str, float]):
    """A stand-in external labeler: reads numbered chunk text, answers reply JSON."""
    marker = re.compile(r"(?m)^(\d+): ")
    word = re.compile(r"[^\W\d_]+")

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in pdf["text"]:
            bodies, expect, last = [], 1, None
            for m in marker.finditer(text or ""):
                if int(m.group(1)) != expect:
                    continue
                if last is not None:
                    bodies.append(text[last:m.start() - 1])
                last, expect = m.end(), expect + 1
            if last is not None:
                bodies.append(text[last:])
            analyses, summary = [], {"positive": 0, "neutral": 0, "negative": 0}
            for i, b in enumerate(bodies, 1):
                score = sum(lexicon.get(t, 0.0) for t in word.findall(b.lower()))
                s = "positive" if score > 0 else "negative" if score < 0 else "neutral"
                summary[s] += 1
                analyses.append({"entry": str(i), "sentiment": s})
            out.append(json.dumps({"analyses": analyses, "summary": summary}, ensure_ascii=False))
        return pdf[["run_id", "chunk_id"]].assign(reply=out)

    return fn


@query("labels_via_hook")
def q_labels_via_hook(spark, sf_dir):
    e = fixtures.entries(spark, sf_dir)
    lex = dict(fixtures.LEXICON)
    rep = labelers.label_with(replies.chunk_text(e), lexicon_reply_stub(lex), "sentiment")
    a = replies.align_labels(e, replies.parse_replies(rep))
    return replies.sentiment_table(a).select("run_id", "chunk_id", "entry_no", "post_id", "sentiment")
