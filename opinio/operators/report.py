"""Report inputs and texts per event.

An event is a validated request; its posts come from the request join (J4) and
carry the native labels. Every text is built by grouped aggregations keyed by
the event: counts are partially aggregated before the shuffle, and the ordered
lists that get rendered hold one row per topic of the event (bounded by the
taxonomy), never the posts themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import NONE_WORD

# The wording of the three report requests.
SENTIMENT_HEAD = "请帮我对 {kw} 事件进行总结，它的累计情感统计:\n"
TOPIC_HEAD = "请帮我对 {kw} 事件进行总结，以下是各主题的讨论量统计：\n"
EVENT_HEAD = "请帮我对 {kw} 事件进行总结，综合以下三部分信息：\n\n"
EVENT_SENTIMENT = "【情感分析总结】:\n"
EVENT_TOPIC = "\n\n【主题分析总结】:\n"
EVENT_TABLE = "\n\n【合并统计信息】:\n"
EVENT_TAIL = "\n\n请生成最终的事件总结。"

SENTS = ("positive", "neutral", "negative")


def _head(template: str, kw: Column) -> Column:
    before, after = template.split("{kw}")
    return F.concat(F.lit(before), kw, F.lit(after))


def pct1(n: Column, total: Column) -> Column:
    """``100 * n / total`` with one decimal, half up, in exact integer arithmetic."""
    tenths = F.when(total > 0, F.floor((F.lit(2000) * n + total) / (F.lit(2) * total))).otherwise(F.lit(0)).cast("long")
    return F.concat(F.floor(tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"))


def event_rows(ev_posts: DataFrame) -> DataFrame:
    """One aggregation per (event, topic) that also carries the event's post counts.

    Every post contributes one row without a topic (its sentiment) and one row per
    topic. Grouping on (request_id, topic) then gives the per-topic mentions and,
    in the topic-less group (``_post_row``), the per-event sentiment counts, so
    the event posts are read and shuffled once for both.
    """
    ex = ev_posts.select("request_id", "post_id", "sentiment", F.posexplode(
        F.concat(F.array(F.lit(None).cast("string")), F.col("topics_arr"))).alias("pos", "topic"))
    return ex.groupBy("request_id", "topic").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTS],
        F.min(F.struct(F.col("post_id"), (F.col("pos") - 1).alias("pos"))).alias("first"),
        F.max(F.col("pos") == 0).alias("_post_row"))


def event_summary(events: DataFrame, rows: DataFrame) -> DataFrame:
    """(request_id, event_keyword, positive, neutral, negative, total, tr) per event.

    ``rows`` is ``event_rows``; a second group-by on the event folds its
    topic-less row into the counts and its topic rows into ``tr`` (one struct per
    topic of the event, NULL when it has none), so every report section is an
    expression over one row and the event posts are read once.
    """
    topic_row = F.struct("first", "topic", "n", *SENTS)
    g = rows.groupBy("request_id").agg(
        *[F.sum(F.when(F.col("_post_row"), F.col(s))).alias(s) for s in SENTS],
        F.collect_list(F.when(~F.col("_post_row"), topic_row)).alias("tr"))
    j = events.select("request_id", "event_keyword").join(g, "request_id", "left")
    cols = [F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in SENTS]
    tr = F.when(F.size("tr") > 0, F.col("tr")).alias("tr")
    out = j.select("request_id", "event_keyword", *cols, tr)
    return out.withColumn("total", F.col("positive") + F.col("neutral") + F.col("negative"))


def sentiment_report_input(counts: DataFrame, key: str = "request_id") -> DataFrame:
    """F15 on counts of native labels or of the replies' own totals (G3): (key, event_keyword, counts)."""
    text = F.concat(_head(SENTIMENT_HEAD, F.col("event_keyword")),
                    F.lit("Positive: "), F.col("positive").cast("string"),
                    F.lit("\nNeutral: "), F.col("neutral").cast("string"),
                    F.lit("\nNegative: "), F.col("negative").cast("string"))
    return counts.select(key, text.alias("text"))


def _sentiment_sentence() -> Column:
    t = F.col("total")
    parts = [F.concat(F.col(s).cast("string"), F.lit(f" {s} posts ("), pct1(F.col(s), t), F.lit("%)")) for s in SENTS]
    return F.concat(F.lit("Of "), t.cast("string"), F.lit(" posts, "), parts[0], F.lit(", "), parts[1],
                    F.lit(" and "), parts[2], F.lit("."))


def sentiment_report_text(counts: DataFrame) -> DataFrame:
    """F20 + M3: the deterministic sentiment report sentence."""
    return counts.select("request_id", _sentiment_sentence().alias("text"))


def _render(tr: Column, key, line, sep: str) -> Column:
    """Lines of the topic rows ``tr`` in the order of ``key(x)``, joined by ``sep``."""
    keyed = F.transform(tr, lambda x: F.struct(key(x).alias("k"), line(x).alias("line")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["line"]), sep)


def _first_seen_lines(tr: Column) -> Column:
    return _render(tr, lambda x: x["first"],
                   lambda x: F.concat(x["topic"], F.lit(": "), x["n"].cast("string"), F.lit("\n")), "")


def _share_lines(tr: Column, total: Column) -> Column:
    return _render(tr, lambda x: F.struct(-x["n"], x["topic"]),
                   lambda x: F.concat(F.lit("'"), x["topic"], F.lit("' accounts for "), x["n"].cast("string"),
                                      F.lit(" posts, "), pct1(x["n"], total), F.lit("% of the total")), "; ")


def _table_lines(tr: Column) -> Column:
    tot = lambda x: x["negative"] + x["neutral"] + x["positive"]
    return F.concat(F.lit("topics negative neutral positive total\n"), _render(
        tr, lambda x: F.struct(-tot(x), x["topic"]),
        lambda x: F.concat_ws(" ", x["topic"], *[x[s].cast("string") for s in ("negative", "neutral", "positive")],
                              tot(x).cast("string")), "\n"))


def _none_if_null(tr: Column, text: Column) -> Column:
    return F.when(tr.isNull(), F.lit(NONE_WORD)).otherwise(text)


def topic_report_input(summary: DataFrame, key: str = "request_id") -> DataFrame:
    """F16: one ``topic: n`` line per topic in first-seen order."""
    return summary.select(key, F.concat(_head(TOPIC_HEAD, F.col("event_keyword")),
                                                 F.coalesce(_first_seen_lines(F.col("tr")), F.lit(""))).alias("text"))


def topic_report_text(summary: DataFrame) -> DataFrame:
    """F20 + M3: ``'topic' accounts for n posts, p% of the total`` per topic; 无 without topics."""
    tr = F.col("tr")
    return summary.select("request_id", _none_if_null(tr, _share_lines(tr, F.col("total"))).alias("text"))


def table_as_text(summary: DataFrame) -> DataFrame:
    """K7: the event's topic x sentiment table as text; 无 when it has no rows."""
    return summary.select("request_id", _none_if_null(F.col("tr"), _table_lines(F.col("tr"))).alias("text"))


def event_report_input(summary: DataFrame) -> DataFrame:
    """J8 + F17: the three summaries of an event, absent ones as 无 (all from the event's one row)."""
    tr = F.col("tr")
    text = F.concat(_head(EVENT_HEAD, F.col("event_keyword")), F.lit(EVENT_SENTIMENT), _sentiment_sentence(),
                    F.lit(EVENT_TOPIC), _none_if_null(tr, _share_lines(tr, F.col("total"))),
                    F.lit(EVENT_TABLE), _none_if_null(tr, _table_lines(tr)), F.lit(EVENT_TAIL))
    return summary.select("request_id", text.alias("text"))


def event_report(events: DataFrame, sentiment: DataFrame | None = None, topic: DataFrame | None = None,
                 table: DataFrame | None = None) -> DataFrame:
    """J8 + F17 from the caller's own summaries, each (request_id, text): a summary that is not given, or has no
    row for an event, reads 无."""
    rows = events.select("request_id", "event_keyword")
    sections = []
    for name, given in (("_sentiment", sentiment), ("_topic", topic), ("_table", table)):
        if given is not None:
            rows = rows.join(given.select("request_id", F.col("text").alias(name)), "request_id", "left")
        sections.append(F.coalesce(F.col(name), F.lit(NONE_WORD)) if given is not None else F.lit(NONE_WORD))
    text = F.concat(_head(EVENT_HEAD, F.col("event_keyword")), F.lit(EVENT_SENTIMENT), sections[0],
                    F.lit(EVENT_TOPIC), sections[1], F.lit(EVENT_TABLE), sections[2], F.lit(EVENT_TAIL))
    return rows.select("request_id", text.alias("text"))
