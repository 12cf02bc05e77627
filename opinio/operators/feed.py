"""Feed pages -> posts (P1-P9) and hour windows.

A page is split before every feed item (P1). An item is cut into tags and texts once; its parts are found by folds
over these tokens (``functions.markup``), so each ends at its own closing tag. Each field is a Column expression,
so the whole extraction is one narrow projection over ``raw_pages``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions import markup
from opinio.functions.feedtime import parse_feed_time
from opinio.functions.text import NONE_WORD, once, unescape_html, utrim
from opinio.session import stage

# The markers of a feed item and of its parts.
ITEM_HEAD = r"""<div\b[^>]*\saction-type\s*=\s*["']?feed_list_item(?=["'\s/>])"""
ITEM_START = rf"(?={ITEM_HEAD})"
MARKS = {
    "item": ("div", markup.tag_with("div", "action-type", "feed_list_item")),
    "short": ("p", markup.tag_with("p", "node-type", "feed_list_content")),
    "full": ("p", markup.tag_with("p", "node-type", "feed_list_content_full")),
    "from": ("div", markup.tag_with_class("div", "from")),
    "acts": ("div", markup.tag_with_class("div", "card-act")),
}
AUTHOR_ATTR = "nick-name"
SOURCE_WORD = "来自"


def split_items(html: Column) -> Column:
    """The feed items of a page, in page order (text before the first item dropped)."""
    return F.filter(F.split(html, ITEM_START), lambda x: x.rlike("^" + ITEM_HEAD))


def feed_items(pages: DataFrame) -> DataFrame:
    """(page_id, item_no 1.., item) for every item of every page."""
    ex = pages.select("page_id", F.posexplode(split_items(F.col("html"))).alias("pos", "item"))
    return ex.select("page_id", (F.col("pos") + 1).cast("int").alias("item_no"), "item")


def item_fields(items: Column) -> Column:
    """Array of items -> array of structs of their fields, NULL when a part is absent.

    Each step is a ``transform`` of its own, so that what later steps use several times is computed once.
    """
    tokens = F.transform(items, lambda i: markup.tokens_of(i, MARKS))
    own = F.transform(tokens, lambda t: F.get(markup.elements(t, [("item", "div")]), 0)["inside"])
    parts = F.transform(own, lambda t: markup.elements(t, [("short", "p"), ("full", "p"), ("from", "div"), ("acts", "div")]))
    counters = ("reposts_raw", "comments_raw", "likes_raw")

    def raw(p: Column) -> Column:
        """As written: the author, then the texts of the time and source, of the body and of the counters."""
        body = F.coalesce(F.get(p, 1)["inside"], F.get(p, 0)["inside"])
        texts = F.concat(F.array(F.get(p, 2)["inside"], body), markup.inside_first(F.get(p, 3)["inside"], "li", len(counters)))
        return F.concat(F.array(markup.attribute(F.get(p, 0)["tag"], AUTHOR_ATTR)), F.transform(texts, markup.joined_text))

    shown = F.transform(F.transform(parts, raw), lambda p: F.transform(p, unescape_html))
    empty, word = F.lit(""), F.lit(SOURCE_WORD)

    def fields(x: Column) -> Column:
        when, body = (F.coalesce(F.get(x, k), empty) for k in (1, 2))
        via = F.when(when.contains(word), utrim(F.split_part(when, word, F.lit(2)))).otherwise(F.lit(NONE_WORD))
        return F.struct(F.nullif(F.get(x, 0), empty).alias("author"), utrim(F.split_part(when, word, F.lit(1))).alias("posted_raw"),
                        via.alias("via"), *[utrim(F.get(x, 3 + k)).alias(c) for k, c in enumerate(counters)],
                        utrim(body).alias("body"))

    return F.transform(shown, fields)


def extract_posts(pages: DataFrame) -> DataFrame:
    """P1-P7 + F1: one row per feed item with the page's window, keyword and parsed time.

    The fields are built inside the item array (one struct per item) before the
    items are exploded. A later filter on a field (P8, P9) then reads a plain
    column instead of having the whole extraction inlined into the predicate,
    which would run every regex twice and overflow generated code.
    """
    ex = pages.select("page_id", "page_no", "keyword", "win_start", "win_end", "fetched_at",
                      F.posexplode(item_fields(split_items(F.col("html")))).alias("pos", "f"))
    return ex.select(
        "page_id", (F.col("pos") + 1).cast("int").alias("item_no"), "page_no", "keyword", "win_start", "win_end",
        "f.*", "fetched_at",
    ).withColumn("posted_at", parse_feed_time(F.col("posted_raw"), F.col("fetched_at"))).drop("fetched_at")


def in_window(posts: DataFrame, lo: str = "win_start", hi: str = "win_end") -> DataFrame:
    """Keep posts whose time lies in the closed window; unparsable times drop."""
    return posts.where(F.col("posted_at").between(F.col(lo), F.col(hi)))


def with_keyword(posts: DataFrame, kw: str = "keyword") -> DataFrame:
    """Literal, case-sensitive containment."""
    return posts.where(F.col("body").contains(F.col(kw)))


def day_windows(days: DataFrame, day_col: str = "day") -> DataFrame:
    """the 24 hour windows [h, h+1h] of every day."""
    start = F.col(day_col).cast("timestamp_ntz")
    return days.select(F.col(day_col), F.explode(F.sequence(
        start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))).alias("win_start")) \
        .withColumn("win_end", F.col("win_start") + F.expr("INTERVAL 1 HOUR"))


def assign_hours_closed(posts: DataFrame, windows: DataFrame, ts: str = "posted_at") -> DataFrame:
    """Posts to the hour windows containing them, both ends closed.

    The range join is an equi-join: a post belongs to the window starting at its
    hour and, when it lies exactly on the hour, also to the previous one.
    """
    h = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    cands = F.when(F.col(ts) == h, F.array(h, h - F.expr("INTERVAL 1 HOUR"))).otherwise(F.array(h))
    ex = posts.withColumn("win_start", F.explode(cands))
    return ex.join(windows.select("win_start", "win_end"), "win_start")


# Characters of a keyword's pieces; shorter keywords are pieces of their own length.
GRAM = 3


def _grams(text: Column, sizes: list[int]) -> Column:
    """Distinct pieces of ``sizes`` characters of a text (size 0: the empty piece), the text scanned once."""
    def heads(pieces: Column, n: int) -> Column:
        return F.array_distinct(F.transform(pieces, lambda p: F.left(p, F.lit(n)))) if n else F.array(F.lit(""))

    pieces = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{GRAM}}}))"), 1))  # the last ones are shorter
    short = [n for n in sizes if n < GRAM]
    return once(pieces, lambda p: F.array_distinct(F.concat(p, *[heads(p, n) for n in short]))) if short else pieces


def posts_for_requests(posts: DataFrame, reqs: DataFrame) -> DataFrame:
    """Posts of each request's day range, closed at its end, that contain its keyword.

    An inverted index on character pieces. A day's posts are cut into their distinct pieces of ``GRAM`` characters
    and meet the pieces of the day's keywords by an equi-join on a 64-bit digest of (day, piece); what is left is
    counted, and each keyword of a day is looked up under the one of its pieces that fewest posts have. Keywords
    shorter than ``GRAM`` are looked up whole among pieces of their own length, an empty keyword under the empty
    piece. The posts found so are verified by ``contains``, so equal digests of different pieces do no harm. No post
    meets a request whose rarest piece it lacks; a keyword that several requests of a day share is looked up once.

    Posts of the days asked for are written once: both the cutting and the verifying read them from there, so the
    plan that makes the posts runs once and their texts are dealt out once, to be verified.

    Requests are exploded to the days they cover and to the day after, of which only posts stamped exactly at its
    midnight belong to them (the last hour window is closed). Posts are told apart by a number of their own, so NULL or
    repeated ids do no harm. All columns of the posts, ``day``, ``request_id`` and ``keyword`` come out.
    """
    offset = F.explode(F.sequence(F.lit(0), F.col("days"))).alias("offset")
    wanted = (reqs.where(F.col("start_date").isNotNull() & F.col("keyword").isNotNull())
              .select("request_id", "keyword", "start_date", "days", offset)
              .select("request_id", "keyword", F.date_add("start_date", F.col("offset")).alias("day"),
                      (F.col("offset") == F.col("days")).alias("only_midnight")))
    wanted = stage(wanted, "wanted-days")
    size = F.least(F.length("keyword"), F.lit(GRAM)).alias("size")
    sizes = sorted(r[0] for r in wanted.select(size).distinct().collect())  # four values at most
    if not sizes:
        return posts.withColumn("day", F.to_date("posted_at")).join(wanted, "day").select(*posts.columns, "day", "request_id", "keyword")
    piece = F.xxhash64("day", "gram").alias("piece")
    terms = stage(wanted.select("day", "keyword").distinct().withColumn("gram", F.explode(F.filter(
        _grams(F.col("keyword"), sizes), lambda g: F.length(g) == F.least(F.length("keyword"), F.lit(GRAM)))))
        .select("day", "keyword", piece), "terms")
    keyed = posts.where(F.col("posted_at").isNotNull() & F.col("body").isNotNull()).withColumn("day", F.to_date("posted_at"))
    keyed = keyed.join(wanted.select("day").distinct(), "day", "left_semi")
    # Written rows keep their ids. Texts are numbered as they lie, so that nothing is dealt out for it.
    keyed = stage(keyed.withColumn("_key", F.monotonically_increasing_id()), "posts-asked")
    found = stage(keyed.select("_key", "day", F.explode(_grams(F.col("body"), sizes)).alias("gram")).select("_key", piece)
                  .join(terms.select("piece").distinct(), "piece"), "found-pieces")
    counts = found.groupBy("piece").agg(F.count("*").alias("n"))
    # a keyword with a piece that no post of the day has is found nowhere; the rest goes under the rarest piece
    index = (terms.join(counts, "piece", "left").groupBy("day", "keyword")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("rarest"))
             .where("rarest.n > 0").select("day", "keyword", F.col("rarest.piece").alias("piece")))
    maybe = found.join(index, "piece").select("_key", "day", "keyword").distinct()
    sure = keyed.join(maybe, ["_key", "day"]).where(F.col("body").contains(F.col("keyword"))).drop("_key")
    midnight = F.col("posted_at") == F.col("day").cast("timestamp_ntz")
    return (sure.join(wanted, ["day", "keyword"]).where(~F.col("only_midnight") | midnight)
            .select(*posts.columns, "day", "request_id", "keyword"))
