"""Labeler replies: parse, check, align with the chunk rows, count.

Everything is keyed by the chunk (run_id, chunk_id): a chunk holds at most ten
entries and two replies, so no key can be hot. The alignment (J2) is one
equi-join on the chunk key plus ``try_element_at(analyses, entry_no)``, with no
explode of the replies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.functions.text import CALL_FAILED_PREFIX, NONE_WORD, clean_topic_array, join_topics, numbered_line, strip_fence, utrim
from opinio.operators.numbering import running_counts
from opinio.session import stage

REPLY_SCHEMA = T.StructType([
    T.StructField("analyses", T.ArrayType(T.StructType([
        T.StructField("entry", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
    ]))),
    T.StructField("summary", T.StructType([
        T.StructField("positive", T.LongType()),
        T.StructField("neutral", T.LongType()),
        T.StructField("negative", T.LongType()),
    ])),
])


def _empty_analyses():
    return F.array().cast(REPLY_SCHEMA["analyses"].dataType)


def parse_replies(replies: DataFrame) -> DataFrame:
    """F2 + F3 + F4 + P18: add clean, status, analyses (default []) and the summary counts."""
    clean = strip_fence(F.col("reply"))
    valid = F.try_parse_json(clean).isNotNull()
    status = (F.when(F.col("reply").startswith(CALL_FAILED_PREFIX), F.lit("call_failed"))
              .when(~valid, F.lit("bad_json")).otherwise(F.lit("ok")))
    parsed = F.from_json(clean, REPLY_SCHEMA)
    return (replies.withColumn("clean", clean)
            .withColumn("status", status)
            .withColumn("_p", F.when(F.col("status") == "ok", parsed))
            .withColumn("analyses", F.when(F.col("status") == "ok",
                                           F.coalesce(F.col("_p.analyses"), _empty_analyses())))
            .withColumn("sum_positive", F.coalesce(F.col("_p.summary.positive"), F.lit(0)))
            .withColumn("sum_neutral", F.coalesce(F.col("_p.summary.neutral"), F.lit(0)))
            .withColumn("sum_negative", F.coalesce(F.col("_p.summary.negative"), F.lit(0)))
            .drop("_p"))


def valid_replies(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == "ok")


def align_labels(entries: DataFrame, parsed: DataFrame, body: str = "body") -> DataFrame:
    """Entry i of a chunk gets ``analyses[i]``; missing -> ""; chunks with a broken reply drop.

    -> (run_id, chunk_id, entry_no, post_id, ``body``, kind, label). ``body`` may name a digest that stands for it. Topic labels are the
    stored ``", "`` string of trimmed, non-blank topics.
    """
    ok = valid_replies(parsed).select("run_id", "chunk_id", "kind", "analyses")
    j = entries.join(ok, ["run_id", "chunk_id"])
    a = F.try_element_at(F.col("analyses"), F.col("entry_no"))
    sent = F.coalesce(a["sentiment"], F.lit(""))
    top = F.when(a.isNull(), F.lit("")).otherwise(
        join_topics(clean_topic_array(F.coalesce(a["topics"], F.array().cast("array<string>")))))
    label = F.when(F.col("kind") == "sentiment", sent).otherwise(top)
    return j.select("run_id", "chunk_id", "entry_no", "post_id", body, "kind", label.alias("label"))


def sentiment_table(aligned: DataFrame) -> DataFrame:
    """The sentiment output table: (run_id, chunk_id, entry_no, post_id, body, sentiment)."""
    return aligned.where(F.col("kind") == "sentiment").drop("kind").withColumnRenamed("label", "sentiment")


def topic_table(aligned: DataFrame) -> DataFrame:
    """The topic output table: (run_id, chunk_id, entry_no, post_id, body, topics)."""
    return aligned.where(F.col("kind") == "topic").drop("kind").withColumnRenamed("label", "topics")


def totals_reported(parsed: DataFrame, *by: str) -> DataFrame:
    """Totals from the replies' own summaries (valid sentiment replies), over all or by the given columns."""
    s = valid_replies(parsed).where(F.col("kind") == "sentiment")
    return s.groupBy(*by).agg(F.sum("sum_positive").cast("long").alias("positive"),
                 F.sum("sum_neutral").cast("long").alias("neutral"),
                 F.sum("sum_negative").cast("long").alias("negative"))


def totals_counted(aligned: DataFrame) -> DataFrame:
    """Recount from the aligned rows."""
    return sentiment_table(aligned).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def reconcile(parsed: DataFrame, aligned: DataFrame) -> DataFrame:
    """Reported vs recounted sentiment per chunk."""
    rep = (valid_replies(parsed).where(F.col("kind") == "sentiment")
           .select("run_id", "chunk_id", "sum_positive", "sum_neutral", "sum_negative"))
    cnt = sentiment_table(aligned).groupBy("run_id", "chunk_id").agg(
        *[F.count_if(F.col("sentiment") == s).alias(f"cnt_{s}") for s in ("positive", "neutral", "negative")])
    j = rep.join(cnt, ["run_id", "chunk_id"], "left")
    out = [F.col("run_id"), F.col("chunk_id")]
    for s in ("positive", "neutral", "negative"):
        c = F.coalesce(F.col(f"cnt_{s}"), F.lit(0)).cast("long")
        out += [F.col(f"sum_{s}").cast("long").alias(f"reported_{s}"), c.alias(f"counted_{s}"),
                (F.col(f"sum_{s}") - c).cast("long").alias(f"diff_{s}")]
    return j.select(*out)


def topic_mentions_all(parsed: DataFrame) -> DataFrame:
    """Every topic of every analysis of every valid topic reply, beyond the chunk end too.

    -> (run_id, chunk_id, entry_idx, topic_pos, topic): trimmed, blanks dropped.
    """
    t = valid_replies(parsed).where(F.col("kind") == "topic")
    e = t.select("run_id", "chunk_id", F.posexplode("analyses").alias("entry_idx", "a"))
    m = e.select("run_id", "chunk_id", "entry_idx",
                 F.posexplode(F.coalesce(F.col("a.topics"), F.array().cast("array<string>"))).alias("topic_pos", "raw"))
    return m.select("run_id", "chunk_id", "entry_idx", "topic_pos", utrim(F.col("raw")).alias("topic")) \
        .where(F.col("topic") != "")


def topic_counts(parsed: DataFrame) -> DataFrame:
    """Mentions per topic (duplicates inside one entry count twice)."""
    return topic_mentions_all(parsed).groupBy("run_id", "topic").agg(F.count(F.lit(1)).alias("n"))


def topic_registry(parsed: DataFrame) -> DataFrame:
    """Distinct topics with their first sighting (chunk, entry, position)."""
    m = topic_mentions_all(parsed)
    first = m.groupBy("run_id", "topic").agg(F.min(F.struct("chunk_id", "entry_idx", "topic_pos")).alias("f"))
    return first.select("run_id", "topic", F.col("f.chunk_id").alias("first_chunk"),
                        F.col("f.entry_idx").alias("first_entry"), F.col("f.topic_pos").alias("first_pos"))


#: Topics of one block of a run's list, as it is stored.
LIST_BLOCK = 256


def topics_seen(chunks: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """W4 on integers: (run_id, chunk_id, n_seen) of every chunk, and (run_id, ordinal, topic) of the registry.

    Chunks and topics are put in one order (run, chunk, a chunk before the topics that it shows first); the number of
    topics before a row is a chunk's ``n_seen`` and a topic's ordinal in its run, so the topics that a chunk sees are
    the first ``n_seen`` of the run. The running count is global (``numbering``): no task holds a run.
    """
    marks = chunks.select("run_id", "chunk_id").distinct().select(
        "run_id", F.col("chunk_id").alias("at"), F.lit(None).cast("int").alias("entry"), F.lit(None).cast("int").alias("pos"),
        F.lit(None).cast("string").alias("topic"))
    first = registry.select("run_id", F.col("first_chunk").alias("at"), F.col("first_entry").cast("int").alias("entry"),
                            F.col("first_pos").cast("int").alias("pos"), "topic")
    order = ["run_id", "at", "entry", "pos", "topic"]  # NULLs first: a chunk comes before its topics
    rows = stage(running_counts(marks.unionByName(first), order, before=F.col("topic").isNotNull()), "topics-seen")
    starts = rows.groupBy("run_id").agg(F.min("before").alias("start"))
    rows = rows.join(starts, "run_id").withColumn("n", F.col("before") - F.col("start"))
    return (rows.where("topic is null").select("run_id", F.col("at").alias("chunk_id"), F.col("n").alias("n_seen")),
            rows.where("topic is not null").select("run_id", F.col("n").alias("ordinal"), "topic"))


def topics_visible(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """W4 + F8: topics first seen in earlier chunks of the run, in first-seen order, or 无.

    A chunk needs one integer (``topics_seen``). A run's list is stored in blocks of ``LIST_BLOCK`` topics; the text of
    its first n topics is put together from the blocks once per n that occurs, not per chunk, and chunks join their
    text at the end. Only that text is as long as the list; it repeats in every chunk, as in the prompts of the
    source program.
    """
    seen, topics = topics_seen(chunks, registry)
    seen, topics = stage(seen, "chunks-seen"), topics.withColumn("block", F.expr(f"ordinal div {LIST_BLOCK}"))
    blocks = topics.groupBy("run_id", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "topic"))),
                                                               lambda t: t["topic"]).alias("names"))
    points = seen.where("n_seen > 0").select("run_id", "n_seen").distinct()
    wanted = points.withColumn("block", F.explode(F.expr(f"sequence(0L, (n_seen - 1) div {LIST_BLOCK})")))
    shown = F.array_join(F.slice("names", F.lit(1), F.least(F.col("n_seen") - F.col("block") * LIST_BLOCK, F.size("names"))), ", ")
    texts = (wanted.join(blocks, ["run_id", "block"]).select("run_id", "n_seen", "block", shown.alias("part"))
             .groupBy("run_id", "n_seen").agg(F.array_sort(F.collect_list(F.struct("block", "part"))).alias("parts"))
             .select("run_id", "n_seen", F.array_join(F.transform("parts", lambda p: p["part"]), ", ").alias("text")))
    return (seen.join(stage(texts, "topic-lists"), ["run_id", "n_seen"], "left")
            .select("run_id", "chunk_id", F.coalesce("text", F.lit(NONE_WORD)).alias("topics_visible")))


def topics_new(registry: DataFrame, known: DataFrame) -> DataFrame:
    """Registry topics that are not in the starting topic list (anti join)."""
    return registry.join(known.select("topic"), "topic", "left_anti")


def chunk_mismatch(entries: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per kind, valid chunks whose number of analyses differs from their rows."""
    n = entries.groupBy("run_id", "chunk_id").agg(F.count(F.lit(1)).alias("n_rows"))
    ok = valid_replies(parsed).select("run_id", "chunk_id", "kind", F.size("analyses").alias("n_analyses"))
    j = ok.join(n, ["run_id", "chunk_id"])
    return j.groupBy("kind").agg(F.count_if(F.col("n_analyses") != F.col("n_rows")).alias("mismatched"),
                                 F.count(F.lit(1)).alias("checked"))


def chunk_text(entries: DataFrame) -> DataFrame:
    """G8 + F13: the ten numbered lines of a chunk, in entry order (groups are at most ten rows)."""
    g = entries.groupBy("run_id", "chunk_id").agg(
        F.array_sort(F.collect_list(F.struct("entry_no", numbered_line(F.col("entry_no"), F.col("body")).alias("line"))))
        .alias("lines"))
    return g.select("run_id", "chunk_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))


# The wording of the topic request for one chunk.
TOPIC_PROMPT_HEAD = "请基于以下公民意见数据和当前主题列表进行主题分析：\n\n公民意见：\n"
TOPIC_PROMPT_LIST = "\n\n当前主题列表："
TOPIC_PROMPT_TAIL = "\n\n"


def chunk_prompts(texts: DataFrame, visible: DataFrame) -> DataFrame:
    """the topic request text of every chunk."""
    j = texts.join(visible, ["run_id", "chunk_id"])
    return j.select("run_id", "chunk_id", F.concat(
        F.lit(TOPIC_PROMPT_HEAD), F.col("text"), F.lit(TOPIC_PROMPT_LIST), F.col("topics_visible"),
        F.lit(TOPIC_PROMPT_TAIL)).alias("prompt"))
