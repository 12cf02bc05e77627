"""Streaming queries (T1-T6): land the input in arrival order, run ``availableNow`` once per
landed part on one checkpoint, and return the final table read back in batch."""

from __future__ import annotations

import datetime as dt
import json
import re

import pandas as pd
from pyspark.sql import functions as F

from opinio.functions.feedtime import ts_text
from opinio.functions.text import join_topics
from opinio.operators import labelers, merge, replies, request_ops
from opinio.plans.registry import query
from opinio.session import scratch_path, stage
from opinio.sources import fixtures, tables
from opinio.streaming import jobs, state


def _paths(spark, label):
    root = scratch_path(spark, label)
    return root, f"{root}/landing", f"{root}/checkpoint"


def _staged(df, root):
    """Write a derived source once under the scratch root, so that landing it in parts does not rebuild it."""
    path = f"{root}/source"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _run_parts(spark, parts, landing, checkpoint, build, fn, output_mode="append"):
    """Land each part, then let the stream catch up (a restart from the checkpoint each time)."""
    schema = parts[0].schema
    for part in parts:
        jobs.land(part, landing)
        jobs.run_available(build(jobs.read_landed(spark, landing, schema)), fn, checkpoint, output_mode)


def _parts(df, col, cut):
    """What arrives first and what arrives then; rows without a time come last."""
    early = F.coalesce(F.col(col) < cut, F.lit(False))
    return [df.where(early), df.where(~early)]


@query("stream_hourly_counts")
def q_stream_hourly_counts(spark, sf_dir):
    """Events per hour, watermark 1 hour, update mode into a state table."""
    root, landing, ckpt = _paths(spark, "stream-hourly")
    ev = tables.events(spark, sf_dir, "event_id", "ts", "event_type")
    cut = F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    hours = state.StateTable(spark, f"{root}/out", "win_start timestamp, n long", state.last_per_key(["win_start"], ["n"]))
    _run_parts(spark, [ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)], landing, ckpt,
               jobs.hourly_counts, hours.write, "update")
    return hours.read().select(F.date_format("win_start", "yyyy-MM-dd HH:mm:ss").alias("win_start"), "n")


@query("stream_labels")
def q_stream_labels(spark, sf_dir):
    """Each micro-batch of posts is labelled and appended (idempotently per batch)."""
    root, landing, ckpt = _paths(spark, "stream-labels")
    p = _staged(fixtures.posts(spark, sf_dir).select("post_id", "posted_at", "body"), root)
    cut = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    out = f"{root}/out"
    lex, tax = fixtures.lexicon(spark), fixtures.taxonomy(spark)

    def fn(batch, batch_id):
        lab = labelers.label_posts(batch, lex, tax, "body")
        jobs.write_batch(lab.select("post_id", "sentiment", join_topics(F.col("topics_arr")).alias("topics")),
                         out, batch_id)

    _run_parts(spark, _parts(p, "posted_at", cut), landing, ckpt,
               lambda s: s, fn)
    return spark.read.parquet(out).select("post_id", "sentiment", "topics")


@query("stream_topic_registry")
def q_stream_topic_registry(spark, sf_dir):
    """The topic list carried across micro-batches in the state store; final registry."""
    root, landing, ckpt = _paths(spark, "stream-registry")
    r = _staged(fixtures.replies(fixtures.entry_rows(spark, sf_dir).rows).where(F.col("kind") == "topic"), root)
    half = r.select(F.max("chunk_id")).first()[0] // 2
    registry = jobs.registry_table(spark, f"{root}/registry")
    _run_parts(spark, [r.where(F.col("chunk_id") <= half), r.where(F.col("chunk_id") > half)], landing, ckpt,
               lambda s: jobs.first_sightings(replies.topic_mentions_all(replies.parse_replies(s))), registry.write, "update")
    return registry.read().select("run_id", "topic", "first_chunk", "first_entry", "first_pos")


@query("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """T4: events of the first three days arrive after the rest; they land in the late table, the others in the
    on-time table (``late`` tells which)."""
    root, landing, ckpt = _paths(spark, "stream-late")
    ev = tables.events(spark, sf_dir, "event_id", "ts", "event_type")
    cut = F.lit(dt.datetime(2024, 1, 4)).cast("timestamp_ntz")
    out, late, mx = f"{root}/out", f"{root}/late", f"{root}/max"
    _run_parts(spark, [ev.where(F.col("ts") >= cut), ev.where(F.col("ts") < cut)], landing, ckpt,
               lambda s: s, jobs.split_late(out, late, mx, delay_seconds=3600))
    both = (spark.read.parquet(out).withColumn("late", F.lit(False))
            .unionByName(spark.read.parquet(late).withColumn("late", F.lit(True))))
    return both.select("event_id", ts_text(F.col("ts")).alias("ts"), "late")


@query("stream_asked_windows")
def q_stream_asked_windows(spark, sf_dir):
    """T4: every user asks for 20 days of events; the first three days land after the rest, with repeats among both.
    What lies outside, late, on time and repeated is told apart by a watermark of 28 days in the stream itself."""
    root, landing, ckpt = _paths(spark, "stream-asked")
    ev = tables.events(spark, sf_dir, "event_id", "ts", "user_id").withColumnRenamed("user_id", "request_id")
    first = F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")
    days = F.make_dt_interval(F.pmod("request_id", F.lit(3)).cast("int"))
    asked = (ev.where("request_id is not null").groupBy("request_id").agg(first.alias("lo"))
             .select("request_id", (F.col("lo") + days).alias("win_start"), (F.col("lo") + days + F.expr("interval 20 days")).alias("win_end")))
    asked = stage(asked, "asked-windows")
    cut = F.lit(dt.datetime(2024, 1, 4)).cast("timestamp_ntz")
    early, rest = ev.where(~F.coalesce(F.col("ts") >= cut, F.lit(False))), ev.where(F.col("ts") >= cut)
    out = f"{root}/out"
    _run_parts(spark, [rest.unionByName(rest.where("event_id % 5 = 0")), early.unionByName(rest.where("event_id % 7 = 0"))],
               landing, ckpt, lambda s: jobs.rows_in_time(s, asked, "event_id", "28 days"),
               lambda batch, batch_id: jobs.write_batch(batch, out, batch_id))
    told = jobs.fates(spark.read.parquet(landing), asked, spark.read.parquet(out), "event_id")
    return told.select("request_id", "event_id", ts_text(F.col("ts")).alias("ts"), "n_rows", "fate")


@query("stream_requests")
def q_stream_requests(spark, sf_dir):
    """S6 + T5: requests stream in as JSON lines, every ninth followed by a line that is cut off; valid ones go to
    the accepted table, others, broken lines too, to the rejects with their status."""
    root, landing, ckpt = _paths(spark, "stream-requests")
    r = _staged(fixtures.requests(spark, sf_dir).select("request_id", "requested_at", "reply"), root)
    acc, rej = f"{root}/accepted", f"{root}/rejected"

    def fn(batch, batch_id):
        v = request_ops.validate_requests(batch)
        broken = F.col("_corrupt_record").isNotNull()
        v = stage(v.select(F.when(~broken, F.col("request_id")).alias("request_id"),
                           F.when(broken, F.lit("bad_line")).otherwise(F.col("status")).alias("status"), "keyword"), "requests")
        jobs.write_batch(v.where(F.col("status") == "ok"), acc, batch_id)
        jobs.write_batch(v.where(F.col("status") != "ok"), rej, batch_id)

    cut = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    line = F.to_json(F.struct("request_id", "requested_at", "reply"))
    cut_off = F.when(F.col("request_id") % 9 == 0, F.left(line, F.lit(30)))
    for part in (F.col("requested_at") < cut, F.col("requested_at") >= cut):
        jobs.land_lines(r.where(part).select(F.explode(F.array_compact(F.array(line, cut_off))).alias("value")), landing)
        jobs.run_available(jobs.read_landed_requests(spark, landing), fn, ckpt)
    cols = [F.col("request_id").cast("string").alias("request_id"), "status", "keyword"]
    return spark.read.parquet(acc).select(*cols).unionByName(spark.read.parquet(rej).select(*cols))


@query("stream_topic_sentiment")
def q_stream_topic_sentiment(spark, sf_dir):
    """Running topic x sentiment counters over a stream of posts.

    Each micro-batch is labelled and counted; a counter is its snapshot and the batches' counts after it, and a
    replayed batch replaces its own.
    """
    root, landing, ckpt = _paths(spark, "stream-ts")
    p = _staged(fixtures.posts(spark, sf_dir).select("post_id", "posted_at", "body"), root)
    cut = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")
    lex, tax = fixtures.lexicon(spark), fixtures.taxonomy(spark)
    counts = ["negative", "neutral", "positive", "total"]
    running = state.StateTable(spark, f"{root}/out", "topic string, " + ", ".join(f"{c} long" for c in counts),
                               state.sum_per_key(["topic"], counts))

    def fn(batch, batch_id):
        m = labelers.label_posts(batch, lex, tax, "body").select(F.explode("topics_arr").alias("topic"), "sentiment")
        running.write(merge.topic_sentiment_counts(m), batch_id)

    _run_parts(spark, _parts(p, "posted_at", cut), landing, ckpt, lambda s: s, fn)
    return running.read()


# ------------------------------------------------------------------ M2 + M5 + T3

def listed_topic_stub(taxonomy: list[tuple[str, str]]):
    """A stand-in external topic labeler: it takes the topics of the shown list that the entries mention, and names
    a new one only where none of them fits; for every tenth chunk (3, 13, ...) the call fails."""
    word = re.compile(r"[^\W\d_]+")

    def answer(chunk_id: int, prompt: str) -> str:
        if chunk_id % 10 == 3:
            raise ConnectionError("no answer")
        entries, _, rest = prompt.rpartition(replies.TOPIC_PROMPT_LIST)
        listed = set(rest.strip().split(", "))
        found = set(word.findall(entries.removeprefix(replies.TOPIC_PROMPT_HEAD).lower()))
        fits = sorted({topic for topic, term in taxonomy if term in found})
        topics = [t for t in fits if t in listed] or fits[chunk_id % max(1, len(fits)):][:1]
        return json.dumps({"analyses": [{"entry": "1", "topics": topics}]})

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[["run_id", "chunk_id"]].assign(reply=[answer(c, t) for c, t in zip(pdf["chunk_id"], pdf["text"])])

    return fn


@query("stream_topic_labelling")
def q_stream_topic_labelling(spark, sf_dir):
    """M2 + M5 + T3: chunks are labelled in three rounds; each round's prompts show the topics that earlier rounds
    found, the labeler prefers these, and a failed call fails its chunk only."""
    root, landing, ckpt = _paths(spark, "stream-labelling")
    texts = _staged(replies.chunk_text(fixtures.entries(spark, sf_dir)), root)
    n = texts.agg(F.max("chunk_id")).first()[0] + 1
    out = f"{root}/replies"
    step = jobs.labelling_step(jobs.registry_table(spark, f"{root}/registry"), out, listed_topic_stub(fixtures.TAXONOMY))
    _run_parts(spark, [texts.where(F.expr(f"chunk_id * 3 div {n}") == k) for k in range(3)], landing, ckpt, lambda s: s, step)
    parsed = replies.parse_replies(spark.read.parquet(out))
    topics = F.coalesce(join_topics(F.get("analyses", F.lit(0))["topics"]), F.lit(""))
    return parsed.select("run_id", "chunk_id", "status", topics.alias("topics"))
