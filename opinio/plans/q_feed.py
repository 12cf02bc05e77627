"""Queries over feed pages, post times, windows and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinio.functions.feedtime import hour_text_to_ts, parse_feed_time, run_stamp, ts_text, ts_to_hour_text
from opinio.functions.text import hashtags, node_text, utrim, without_hashtags
from opinio.operators import feed, request_ops
from opinio.plans.registry import query
from opinio.session import stage
from opinio.sources import fixtures, tables

FEED_COLS = ["page_id", "item_no", "page_no", "keyword", "win_start", "win_end", "author", "posted_raw",
             "via", "reposts_raw", "comments_raw", "likes_raw", "body", "posted_at"]


def _as_text(df, *cols):
    for c in cols:
        df = df.withColumn(c, ts_text(F.col(c)))
    return df


def _feed_posts(spark, sf_dir):
    return feed.extract_posts(fixtures.raw_pages(spark, sf_dir))


@query("src_raw_pages")
def q_src_raw_pages(spark, sf_dir):
    """S3: the landed page table, scanned with only the needed columns."""
    p = tables.pages(spark, sf_dir, "page_id", "url", "html")
    return p.select("page_id", "url", F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1).alias("host"),
                    F.length("html").cast("long").alias("n_chars"))


@query("page_paragraphs")
def q_page_paragraphs(spark, sf_dir):
    """P1 on real pages: title and number of <p> elements outside script and style."""
    p = tables.pages(spark, sf_dir, "page_id", "html")
    body = F.regexp_replace(F.regexp_replace("html", r"(?s)<script[^>]*>.*?</script>", ""),
                            r"(?s)<style[^>]*>.*?</style>", "")
    return p.select("page_id", node_text(F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1)).alias("title"),
                    F.size(F.regexp_extract_all(body, F.lit(r"<p[ >]"), 0)).cast("long").alias("n_paragraphs"))


@query("feed_items")
def q_feed_items(spark, sf_dir):
    return feed.feed_items(fixtures.raw_pages(spark, sf_dir))


@query("feed_posts")
def q_feed_posts(spark, sf_dir):
    return _as_text(_feed_posts(spark, sf_dir).select(*FEED_COLS), "win_start", "win_end", "posted_at")


@query("posts_in_range")
def q_posts_in_range(spark, sf_dir):
    return _as_text(feed.in_window(_feed_posts(spark, sf_dir)).select(*FEED_COLS), "win_start", "win_end", "posted_at")


@query("posts_with_keyword")
def q_posts_with_keyword(spark, sf_dir):
    return _as_text(feed.with_keyword(_feed_posts(spark, sf_dir)).select(*FEED_COLS), "win_start", "win_end",
                    "posted_at")


@query("feed_time")
def q_feed_time(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir).select("post_id", "posted_raw")
    ref = F.lit(fixtures.REF_TS).cast("timestamp_ntz")
    return p.select("post_id", "posted_raw", ts_text(parse_feed_time(F.col("posted_raw"), ref)).alias("posted_at"))


def _post_days(spark, sf_dir):
    return fixtures.posts(spark, sf_dir).select(F.to_date("posted_at").alias("day")).distinct()


@query("hour_windows")
def q_hour_windows(spark, sf_dir):
    w = feed.day_windows(_post_days(spark, sf_dir))
    start_text = ts_to_hour_text(F.col("win_start"))
    return w.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.hour("win_start").alias("hour"),
                    start_text.alias("win_start"), ts_to_hour_text(F.col("win_end")).alias("win_end"),
                    ts_text(hour_text_to_ts(start_text)).alias("start_parsed"))


def _hourly(spark, sf_dir):
    posts = fixtures.posts(spark, sf_dir)
    return feed.assign_hours_closed(posts, feed.day_windows(_post_days(spark, sf_dir)))


@query("posts_by_hour_closed")
def q_posts_by_hour_closed(spark, sf_dir):
    return _hourly(spark, sf_dir).select("post_id", ts_text(F.col("win_start")).alias("win_start"))


@query("posts_union")
def q_posts_union(spark, sf_dir):
    """Posts landed from pages and posts from the table appended by column name."""
    a = _feed_posts(spark, sf_dir).select(F.lit("feed").alias("src"), "page_id", "item_no", "author", "posted_raw",
                                          "via", "body")
    b = fixtures.posts(spark, sf_dir).select(F.lit("table").alias("src"), "post_id", "author", "posted_raw", "via",
                                             "body")
    return a.unionByName(b, allowMissingColumns=True)


@query("posts_dedup")
def q_posts_dedup(spark, sf_dir):
    """The hourly crawl repeats on-the-hour posts; keep one row per (author, time, body)."""
    h = _hourly(spark, sf_dir)
    d = h.groupBy("author", "posted_at", "body").agg(F.count(F.lit(1)).alias("n_copies"),
                                                     F.min("post_id").alias("post_id"))
    return d.withColumn("posted_at", ts_text(F.col("posted_at")))


def _validated(spark, sf_dir):
    return request_ops.validate_requests(fixtures.requests(spark, sf_dir), days=F.col("request_id") % 2 + 1)


@query("requests_validated")
def q_requests_validated(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return v.select("request_id", "status", "keyword", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"))


@query("request_fields")
def q_request_fields(spark, sf_dir):
    return request_ops.request_fields(fixtures.requests(spark, sf_dir))


@query("run_stamp")
def q_run_stamp(spark, sf_dir):
    """K6: the output name of each request's run, stamped with its time."""
    r = fixtures.requests(spark, sf_dir)
    return r.select("request_id", F.concat(F.lit("微博数据_"), run_stamp(F.col("requested_at")), F.lit(".csv"))
                    .alias("file_name"))


@query("posts_for_requests")
def q_posts_for_requests(spark, sf_dir):
    ok = stage(_validated(spark, sf_dir).where(F.col("status") == "ok"), "requests")  # parsed once
    posts = fixtures.posts(spark, sf_dir).select("post_id", "posted_at", "body")
    return feed.posts_for_requests(posts, ok).select("request_id", "post_id")


@query("hashtags")
def q_hashtags(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    ex = d.select("doc_id", F.posexplode(hashtags(F.col("text"))).alias("pos", "tag"))
    return ex.select("doc_id", (F.col("pos") + 1).cast("int").alias("tag_no"), "tag")


@query("body_no_hashtags")
def q_body_no_hashtags(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", without_hashtags(F.col("text")).alias("text"))


@query("utrim_check")
def q_utrim_check(spark, sf_dir):
    """F5 over every text: Unicode trim (Python strip) vs the raw text."""
    d = tables.conversations(spark, sf_dir, "conv_id", "turn", "text")
    t = utrim(F.col("text"))
    return d.select("conv_id", "turn", t.alias("text"), (F.length("text") - F.length(t)).cast("long").alias("n_trimmed"))
