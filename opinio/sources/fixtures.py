"""Input tables of the opinion pipeline, derived by Spark from the landed test tables.

The source program starts from a crawl and a hosted model; neither exists here, so
posts, feed pages, chunk replies and requests are derived deterministically from
``documents`` and ``events`` (rules in FIXTURES.md). Every builder is a lazy plan
over the full tables, so its work grows with them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.text import first_token
from opinio.operators.labelers import label_posts
from opinio.operators.numbering import chunk_rows
from opinio.session import stage
from opinio.sources import tables

# Fixture parameters.
REF_TS = dt.datetime(2024, 1, 31, 0, 0, 0)          # fetch time of every landed page
RUN_ID = "r1"
PAGE_KEYWORD = "the"
PAGE_WIN_START = dt.datetime(2024, 1, 1, 6, 0, 0)
PAGE_WIN_END = dt.datetime(2024, 1, 2, 0, 0, 0)
PAGE_HEAD = '<html><body><div id="pl_feedlist_index">'
PAGE_TAIL = "</div></body></html>"
ITEM_OPEN = '<div class="card-wrap" action-type="feed_list_item">'

# The lexicon (term, weight) and the taxonomy (topic, term).
LEXICON = [("as", 1.0), ("was", 1.0), ("les", 1.0), ("por", 1.0),
           ("are", -1.0), ("inst", -1.0), ("der", -1.0), ("del", -1.0)]
TAXONOMY = [("t_it", "it"), ("t_from", "from"), ("t_sich", "sich"),
            ("t_pour", "pour"), ("t_para", "para"), ("t_this", "this")]
STOP_TOPICS = ["t_this"]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, weight double")


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAXONOMY, "topic string, term string")


def stop_topics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in STOP_TOPICS], "topic string")


def known_sentiments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("negative",), ("neutral",), ("positive",)], "sentiment string")


def _lit_ts(v: dt.datetime):
    return F.lit(v).cast("timestamp_ntz")


# ----------------------------------------------------------------------------- posts

def posts(spark: SparkSession, sf_dir: str, body=lambda text: text) -> DataFrame:
    """posts(post_id, page_no, author, posted_at, posted_raw, via, reposts_raw, comments_raw, likes_raw, body).

    ``body`` gives what a caller needs of a text; it is taken before the texts meet the events.
    """
    d = tables.documents(spark, sf_dir, "doc_id", "text", "source").withColumn("text", body(F.col("text")))
    e = tables.events(spark, sf_dir, "event_id", "ts")
    j = d.join(e, d.doc_id == e.event_id, "left")  # a document without an event has no time
    at = F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz")
    hm = F.date_format(at, "HH:mm")
    k = F.col("doc_id") % 9
    raw = (F.when(k == 0, F.date_format(at, "yyyy'年'MM'月'dd'日' HH:mm"))
           .when(k == 1, F.date_format(at, "MM'月'dd'日' HH:mm"))
           .when(k == 2, F.date_format(at, "yyyy-MM-dd HH:mm"))
           .when(k == 3, F.date_format(at, "yyyy-MM-dd"))
           .when(k == 4, F.lit("刚刚"))
           .when(k == 5, F.concat(F.lit("今天 "), hm))
           .when(k == 6, F.concat((F.col("doc_id") % 60).cast("string"), F.lit("分钟前")))
           .when(k == 7, F.concat((F.col("doc_id") % 24).cast("string"), F.lit("小时前")))
           .otherwise(F.concat(F.lit("昨天 "), hm)))
    v = F.col("doc_id") % 3
    via = F.when(v == 1, F.lit("iPhone客户端")).when(v == 2, F.lit("微博网页版"))
    return j.select(
        F.col("doc_id").alias("post_id"),
        (F.col("doc_id") % 49 + 1).cast("int").alias("page_no"),
        F.col("source").alias("author"),
        at.alias("posted_at"),
        raw.alias("posted_raw"),
        via.alias("via"),
        (F.col("doc_id") % 7).cast("string").alias("reposts_raw"),
        (F.col("doc_id") % 5).cast("string").alias("comments_raw"),
        (F.col("doc_id") % 11).cast("string").alias("likes_raw"),
        F.col("text").alias("body"),
    )


# ------------------------------------------------------------------------ feed pages

def _esc(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def feed_item_html(p: DataFrame) -> DataFrame:
    """One feed item per post, in markup of three kinds (``post_id % 3``): attributes in any order, more class
    names, nested elements, character references. Even posts have a teaser and the full text, odd posts the
    full text only. Of ``post_id % 50``, 10 lacks the time and source, 20 the counters, 30 the content."""
    i = F.col("post_id")
    kind, odd_one = i % 3, i % 50

    def of_kind(*texts):
        return F.when(kind == 0, F.lit(texts[0])).when(kind == 1, F.lit(texts[1])).otherwise(F.lit(texts[2]))

    def unless(k, *parts):
        return F.when(odd_one == k, F.lit("")).otherwise(F.concat(*parts))

    def text(c):
        esc = _esc(c)
        return (F.when(kind == 1, F.replace(F.replace(esc, F.lit("'"), F.lit("&#39;")), F.lit("é"), F.lit("&#233;")))
                .when(kind == 2, F.concat(F.lit("&nbsp;"), F.replace(esc, F.lit("ü"), F.lit("&#xFC;")), F.lit("<br/>")))
                .otherwise(esc))

    full = F.when(i % 2 == 0, F.concat(
        of_kind('<p node-type="feed_list_content_full">', '<p style="display: none" node-type="feed_list_content_full">',
                '<p node-type="feed_list_content_full" class="txt">'), text(F.col("body")), F.lit("</p>\n"))).otherwise("")
    short = F.when(i % 2 == 0, F.substring(F.col("body"), 1, 60)).otherwise(F.col("body"))
    content = unless(30, of_kind('<p node-type="feed_list_content" nick-name="', '<p class="txt" nick-name="',
                                 '<p class="txt hot" data-k="1" node-type="feed_list_content" nick-name="'),
                     _esc(F.col("author")), of_kind('">', '" node-type="feed_list_content">', '">'), text(short),
                     F.lit("</p>\n"), full)
    via = F.when(F.col("via").isNotNull(), F.concat(
        F.lit("来自"), of_kind("", "", '<a rel="nofollow">'), F.col("via"), of_kind("", "", "</a>"))).otherwise(F.lit(""))
    when = unless(10, of_kind('<div class="from">', '<div class="from s">', '<div data-k="1" class="card from">'),
                  of_kind("", "", '<a href="#">'), F.col("posted_raw"), of_kind("", "", "</a> "), via, F.lit("</div>\n"))
    li, end = of_kind("<li>", '<li class="n"><div><a href="#">', "<li><span>"), of_kind("</li>", "</a></div></li>", "</span></li>")
    acts = unless(20, of_kind('<div class="card-act">', '<div class="card-act s">', '<div id="x" class="card-act">'),
                  F.lit("<ul>"), *[x for c in ("reposts_raw", "comments_raw", "likes_raw") for x in (li, F.col(c), end)],
                  F.lit("</ul></div>"))
    item = F.concat(F.lit(ITEM_OPEN), F.lit('<a nick-name="someone else" href="#">x</a>'), content, when, acts, F.lit("</div>"))
    return p.select("post_id", item.alias("item"))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_pages(page_id, keyword, win_start, win_end, page_no, fetched_at, html): ten posts a page."""
    return pages_of(posts(spark, sf_dir))


def pages_of(p: DataFrame) -> DataFrame:
    """The ``raw_pages`` of the given posts."""
    items = feed_item_html(p).withColumn("page_id", F.floor(F.col("post_id") / 10).cast("long"))
    pages = items.groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("post_id", "item"))), lambda x: x["item"]), "")
        .alias("body"))
    return pages.select(
        "page_id",
        F.lit(PAGE_KEYWORD).alias("keyword"),
        _lit_ts(PAGE_WIN_START).alias("win_start"),
        _lit_ts(PAGE_WIN_END).alias("win_end"),
        (F.col("page_id") % 49 + 1).cast("int").alias("page_no"),
        _lit_ts(REF_TS).alias("fetched_at"),
        F.concat(F.lit(PAGE_HEAD), F.col("body"), F.lit(PAGE_TAIL)).alias("html"),
    )


# ------------------------------------------------------------------ entries, replies

def labelled_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_posts(posts(spark, sf_dir), lexicon(spark), taxonomy(spark), "body")


def entry_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, chunk_id, entry_no, post_id): ten posts a chunk; only the ids are read."""
    numbers = chunk_rows(stage(posts(spark, sf_dir).select("post_id"), "post-ids"), ["post_id"], 10)
    return numbers.select(F.lit(RUN_ID).alias("run_id"), "chunk_id", "entry_no", "post_id")


@dataclass
class EntryRows:
    rows: DataFrame    # run_id, chunk_id, entry_no, post_id, body_key, sentiment, topics_arr, _row
    bodies: DataFrame  # _row (once each), body


def entry_rows(spark: SparkSession, sf_dir: str) -> EntryRows:
    """The entries without their bodies, which ``body_key`` (a digest) stands for, and the bodies beside them.

    The documents are read and labelled once, and bodies are written once. Only ids meet the events (a document is as many
    posts as it has events, one without any) and are numbered; posts of one document share its ``_row``.
    """
    d = tables.documents(spark, sf_dir, "doc_id", "text").select(F.col("doc_id").alias("post_id"), F.col("text").alias("body"))
    src = (label_posts(d, lexicon(spark), taxonomy(spark), "body")
           .select("post_id", "body", F.sha2("body", 256).alias("body_key"), "sentiment", "topics_arr"))
    src = stage(src.withColumn("_row", F.monotonically_increasing_id()), "labelled-posts")
    e = tables.events(spark, sf_dir, "event_id")
    posts_of = stage(src.select("post_id", "_row").join(e, F.col("post_id") == e.event_id, "left").drop("event_id"), "post-ids")
    numbers = chunk_rows(posts_of, ["post_id"], 10).drop("post_id")
    rows = stage(src.drop("body").join(numbers, "_row").select(F.lit(RUN_ID).alias("run_id"), "chunk_id", "entry_no", "post_id",
                                                               "body_key", "sentiment", "topics_arr", "_row"), "entries")
    return EntryRows(rows, src.select("_row", "body"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entries(run_id, chunk_id, entry_no, post_id, body, sentiment, topics_arr): ten posts a chunk."""
    e = entry_rows(spark, sf_dir)
    return e.rows.join(e.bodies, "_row").select("run_id", "chunk_id", "entry_no", "post_id", "body", "sentiment", "topics_arr")


def _json_reply(kind_json, chunk_id):
    """Apply the defect of ``chunk_id % 10`` (FIXTURES.md) to a JSON reply text."""
    d = chunk_id % 10
    return (F.when(d == 1, F.concat(F.lit("Here is the analysis:\n```json\n"), kind_json,
                                    F.lit("\n```\nLet me know if you need more.")))
            .when(d == 3, F.lit("调用接口失败：timeout"))
            .otherwise(kind_json))


def replies(e: DataFrame) -> DataFrame:
    """replies(run_id, chunk_id, kind, reply): what a labeler answered for each chunk of the entries."""
    d = F.col("chunk_id") % 10
    g = e.groupBy("run_id", "chunk_id").agg(
        F.array_sort(F.collect_list(F.struct("entry_no", "sentiment", "topics_arr"))).alias("rows"),
        F.count_if(F.col("sentiment") == "positive").alias("pos"),
        F.count_if(F.col("sentiment") == "neutral").alias("neu"),
        F.count_if(F.col("sentiment") == "negative").alias("neg"))
    n = F.size("rows")
    sent = F.transform("rows", lambda r: F.struct(
        r["entry_no"].cast("string").alias("entry"),
        F.when((d == 9) & (r["entry_no"] == 1), F.lit("mixed")).otherwise(r["sentiment"]).alias("sentiment")))
    top = F.transform("rows", lambda r: F.struct(
        r["entry_no"].cast("string").alias("entry"),
        F.when((d == 8) & (r["entry_no"] == 1), F.array_append(r["topics_arr"], F.lit("a,b")))
        .otherwise(r["topics_arr"]).alias("topics")))
    sent = (F.when(d == 5, F.slice(sent, 1, n - 1))
            .when(d == 7, F.array_append(sent, F.struct(F.lit("extra").alias("entry"), F.lit("neutral").alias("sentiment"))))
            .otherwise(sent))
    top = (F.when(d == 5, F.slice(top, 1, n - 1))
           .when(d == 7, F.array_append(top, F.struct(F.lit("extra").alias("entry"),
                                                      F.array(F.lit("t_extra")).alias("topics"))))
           .otherwise(top))
    summary = F.struct(
        (F.col("pos") + F.when(d == 9, 1).otherwise(0)).alias("positive"),
        F.col("neu").alias("neutral"), F.col("neg").alias("negative"))
    sent_json = F.to_json(F.struct(sent.alias("analyses"), summary.alias("summary")))
    top_json = F.to_json(F.struct(top.alias("analyses")))
    both = g.select("run_id", "chunk_id", F.explode(F.array(
        F.struct(F.lit("sentiment").alias("kind"), _json_reply(sent_json, F.col("chunk_id")).alias("reply")),
        F.struct(F.lit("topic").alias("kind"), _json_reply(top_json, F.col("chunk_id")).alias("reply")),
    )).alias("r"))
    return both.select("run_id", "chunk_id", "r.kind", "r.reply")


# ---------------------------------------------------------------------------- requests

def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests(request_id, requested_at, reply, text): one per (day, author) of the posts.

    ``reply`` is an extractor's JSON answer with the defect of ``request_id % 7``;
    ``text`` is a free-text request in one of four wordings (``request_id % 4``).
    """
    p = posts(spark, sf_dir, body=first_token).select("post_id", "author", "posted_at", "body")
    per = (p.where(F.col("posted_at").isNotNull()).withColumn("day", F.to_date("posted_at"))
           .groupBy("day", "author")
           .agg(F.min_by(F.col("body"), F.col("post_id")).alias("kw"),
                F.min("posted_at").alias("requested_at")))
    # 60 bits of a digest of (day, author), whatever the author's name looks like
    key = F.concat_ws("|", F.date_format("day", "yyyy-MM-dd"), F.coalesce("author", F.lit("")))
    per = per.withColumn("request_id", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"))
    y = F.year("day").cast("string")
    m = F.month("day").cast("string")
    dd = F.dayofmonth("day").cast("string")
    kws = F.when(F.col("kw").isNull(), F.lit("[]")).otherwise(F.concat(F.lit('["#'), F.col("kw"), F.lit('#"]')))

    def body(platform, month, with_day=True, keywords=kws):
        parts = [F.lit('{"event_keywords":'), keywords, F.lit(',"start_year":"'), y, F.lit('","start_month":"'), month]
        if with_day:
            parts += [F.lit('","start_day":"'), dd]
        parts += [F.lit('","event_release_platform":"'), F.lit(platform), F.lit('"}')]
        return F.concat(*parts)

    v = F.col("request_id") % 7
    reply = (F.when(v == 0, body("Weibo", m))
             .when(v == 1, F.concat(F.lit("```json\n"), body("微博", m), F.lit("\n```")))
             .when(v == 2, body("other", m))
             .when(v == 3, body("Weibo", m, with_day=False))
             .when(v == 4, body("Weibo", F.lit("Jan")))
             .when(v == 5, F.lit("Which day do you mean?"))
             .otherwise(body("Weibo", m, keywords=F.lit("[]"))))
    kwt = F.coalesce(F.col("kw"), F.lit(""))
    w = F.col("request_id") % 4
    text = (F.when(w == 0, F.concat(F.lit("请分析#"), kwt, F.lit("# "), F.date_format("day", "yyyy-MM-dd"), F.lit(" 微博")))
            .when(w == 1, F.concat(F.lit("#"), kwt, F.lit("# "), y, F.lit("年"), m, F.lit("月"), dd, F.lit("日 Weibo")))
            .when(w == 2, F.concat(F.lit("#"), kwt, F.lit("# Weibo")))
            .otherwise(F.date_format("day", "yyyy-MM-dd")))
    return per.select("request_id", "requested_at", reply.alias("reply"), text.alias("text"))
