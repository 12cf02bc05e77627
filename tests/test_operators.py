"""Operators on hand rows: J1, J2, J3, G1/G2, O1, W1/W2 numbering, M1/M2 labelers."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from opinio.operators import feed, labelers, merge, numbering, replies, report
from opinio.operators.conversations import conversation_history
from opinio.plans import q_io
from opinio.sources import files, fixtures
from opinio.streaming import jobs, state
from tests.conftest import SF_SMALL


def test_merge_labels_null_safe_and_duplicates(spark):
    # The J1 rows of FIXTURES.md -> 6 rows.
    topics = spark.createDataFrame([(1, "x", "t1"), (1, "x", "t2"), (2, None, "t3"), (3, "z", "")],
                                   "entry_no int, body string, topics string")
    sent = spark.createDataFrame([(1, "x", "positive"), (1, "x", "negative"), (2, None, "neutral")],
                                 "entry_no int, body string, sentiment string")
    m = merge.merge_labels(topics, sent)
    assert m.agg(F.sum("n")).first()[0] == 6
    rows = {(r["entry_no"], r["topics"], r["sentiment"]): r["n"] for r in m.collect()}
    assert rows[(2, "t3", "neutral")] == 1          # NULL body matched NULL body
    assert rows[(3, "", None)] == 1                  # no partner: kept, sentiment NULL
    assert rows[(1, "t1", "positive")] == 1 and rows[(1, "t1", "negative")] == 1


def test_topic_sentiment_counts_unknown_and_null(spark):
    m = spark.createDataFrame([("a", "positive", 2), ("a", "mixed", 1), ("b", None, 1), ("a", "negative", 1)],
                              "topic string, sentiment string, n long")
    out = {r["topic"]: r.asDict() for r in merge.topic_sentiment_counts(m).collect()}
    assert out["a"]["positive"] == 2 and out["a"]["negative"] == 1 and out["a"]["total"] == 3
    assert out["b"]["total"] == 0                    # topic row stays with zeros
    for r in out.values():
        assert r["total"] == r["negative"] + r["neutral"] + r["positive"]


def test_rank_by_total_is_dense_and_ordered(spark):
    ts = spark.createDataFrame([("a", 0, 0, 3, 3), ("b", 1, 1, 1, 3), ("c", 0, 0, 9, 9), ("d", 0, 0, 0, 0)],
                               "topic string, negative long, neutral long, positive long, total long")
    out = [(r["rank"], r["topic"]) for r in merge.rank_by_total(ts).orderBy("rank").collect()]
    assert out == [(1, "c"), (2, "a"), (3, "b"), (4, "d")]


def test_align_short_extra_broken(spark):
    entries = spark.createDataFrame(
        [("r", c, e, c * 10 + e, f"body {c}.{e}") for c in (0, 1, 2) for e in (1, 2, 3)],
        "run_id string, chunk_id long, entry_no int, post_id long, body string")
    good = {"analyses": [{"entry": "1", "sentiment": "positive"}, {"entry": "2", "sentiment": "negative"}],
            "summary": {"positive": 1, "neutral": 0, "negative": 1}}
    extra = {"analyses": [{"entry": str(i), "sentiment": "neutral"} for i in range(1, 5)]}
    reps = spark.createDataFrame([
        ("r", 0, "sentiment", "```json\n" + json.dumps(good) + "\n```"),   # short by one
        ("r", 1, "sentiment", json.dumps(extra)),                          # one too many
        ("r", 2, "sentiment", "调用接口失败：timeout"),                       # broken
    ], "run_id string, chunk_id long, kind string, reply string")
    parsed = replies.parse_replies(reps)
    assert {r["chunk_id"]: r["status"] for r in parsed.collect()} == {0: "ok", 1: "ok", 2: "call_failed"}
    a = {(r["chunk_id"], r["entry_no"]): r["label"] for r in replies.align_labels(entries, parsed).collect()}
    assert a == {(0, 1): "positive", (0, 2): "negative", (0, 3): "",
                 (1, 1): "neutral", (1, 2): "neutral", (1, 3): "neutral"}


def test_closed_hour_windows_duplicate_on_the_hour(spark):
    posts = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5, 0)), (2, dt.datetime(2024, 1, 1, 5, 30)),
                                   (3, dt.datetime(2024, 1, 2, 0, 0))], "post_id long, posted_at timestamp_ntz")
    days = spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date")
    got = sorted((r["post_id"], r["win_start"].hour) for r in
                 feed.assign_hours_closed(posts, feed.day_windows(days)).collect())
    # post 1 lies on 05:00: windows 04-05 and 05-06; post 3 closes the day's last window (23-24).
    assert got == [(1, 4), (1, 5), (2, 5), (3, 23)]


def test_global_row_number_equals_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"), F.col("id").alias("v"))
    got = numbering.global_row_number(df, ["k"], "rn", num_partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k")) - 1)
    assert got.select("k", "rn").exceptAll(want.select("k", "rn")).count() == 0
    assert got.count() == 5000
    # the general (multi-column) path gives the same numbers
    got2 = numbering.global_row_number(df, [F.col("k").desc()], "rn", num_partitions=5)
    want2 = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("k").desc())) - 1)
    assert got2.select("k", "rn").exceptAll(want2.select("k", "rn")).count() == 0


def test_chunks_hold_at_most_ten(spark):
    df = spark.range(0, 95).withColumnRenamed("id", "post_id")
    ch = numbering.chunk_rows(df, ["post_id"], 10, num_partitions=4)
    sizes = [r["count"] for r in ch.groupBy("chunk_id").count().collect()]
    assert max(sizes) == 10 and sum(sizes) == 95 and len(sizes) == 10
    assert ch.where(F.col("chunk_id") * 10 + F.col("entry_no") - 1 != F.col("post_id")).count() == 0


LEX = [("as", 1.0), ("was", 1.0), ("der", -1.0), ("del", -1.0), ("alpha", 1.0)]
TAX = [("t_it", "it"), ("t_thing", "thing"), ("t_it", "thing"), ("t", "alpha"), ("t", "alpha"), ("t", None), (None, "it")]
LABEL_ROWS = [(1, "It was the thing, as it was."), (2, "Der Hund und del mar"), (3, "nothing here"), (4, None),
              (None, "alpha beta"), (None, "der del"), (1, "It was the thing, as it was.")]


def _labels(df):
    return sorted((str(r["doc_id"]), str(r["text"]), r["sentiment"], [t for t in r["topics_arr"] if t]) for r in df.collect())


def test_both_labeler_methods_agree(spark):
    # NULL and repeated keys, repeated and NULL dimension rows
    docs = spark.createDataFrame(LABEL_ROWS, "doc_id long, text string").repartition(3)
    lex = spark.createDataFrame(LEX, "term string, weight double")
    tax = spark.createDataFrame([r for r in TAX if r[0]], "topic string, term string")
    for min_hits in (1, 2):
        small = _labels(labelers.label_posts(docs, lex, tax, "text", min_hits=min_hits))
        large = _labels(labelers.label_topics_by_join(labelers.label_sentiment_by_join(docs, lex, "text"), tax, "text",
                                                      min_hits=min_hits))
        assert large == small
        if min_hits == 1:
            assert ("None", "alpha beta", "positive", ["t"]) in small and ("None", "der del", "negative", []) in small
        else:
            assert ("None", "alpha beta", "positive", []) in small  # a repeated taxonomy row is one term


def test_labelers_without_key_and_on_a_stream(spark, tmp_path):
    docs = spark.createDataFrame([(t,) for _, t in LABEL_ROWS], "text string")
    lex = spark.createDataFrame(LEX, "term string, weight double")
    assert labelers.label_sentiment_by_join(docs, lex, "text").count() == len(LABEL_ROWS)
    docs.write.parquet(str(tmp_path / "in"))
    out = []

    def fn(batch, batch_id):
        out.extend(r["sentiment"] for r in labelers.label_sentiment_by_join(batch, lex, "text").collect())

    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    jobs.run_available(stream, fn, str(tmp_path / "ckpt"))
    small = [r["sentiment"] for r in labelers.label_sentiment(docs, lex, "text").collect()]
    assert sorted(out) == sorted(small)
    jobs.run_available(labelers.label_sentiment(stream, lex, "text"), lambda b, i: out.append(b.count()),
                       str(tmp_path / "ckpt2"))
    assert out[-1] == len(LABEL_ROWS)


def test_a_dimension_too_large_for_a_map_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(labelers, "MAP_TERMS", 2)
    with pytest.raises(ValueError, match="joins"):
        labelers.lexicon_map(spark.createDataFrame(LEX, "term string, weight double"))


def test_topics_visible_matches_brute_force(spark):
    # topics first seen at chunks 0, 3, 4 and 9 of run a; run b has none
    reg = spark.createDataFrame(
        [("a", "x", 0, 1, 0), ("a", "y", 0, 0, 1), ("a", "z", 3, 2, 0), ("a", "w", 4, 1, 0), ("a", "v", 9, 1, 0)],
        "run_id string, topic string, first_chunk long, first_entry int, first_pos int")
    chunks = spark.createDataFrame([("a", c) for c in range(12)] + [("b", c) for c in range(3)],
                                   "run_id string, chunk_id long")
    got = {(r["run_id"], r["chunk_id"]): r["topics_visible"]
           for r in replies.topics_visible(chunks, reg).collect()}
    order = sorted(reg.collect(), key=lambda r: (r["first_chunk"], r["first_entry"], r["first_pos"]))
    for (run, k), text in got.items():
        seen = [r["topic"] for r in order if r["run_id"] == run and r["first_chunk"] < k]
        assert text == (", ".join(seen) if seen else "无"), (run, k)
    assert len(got) == 15


def test_topics_visible_with_a_hundred_thousand_topics(spark):
    """One run; 4,000 topics a chunk. A text is put together once for all chunks that see the same topics."""
    reg = spark.range(0, 100_000).select(
        F.lit("a").alias("run_id"), F.concat(F.lit("t"), F.col("id")).alias("topic"), F.expr("id div 4000").alias("first_chunk"),
        F.expr("cast(id % 4000 div 10 as int)").alias("first_entry"), (F.col("id") % 10).cast("int").alias("first_pos"))
    chunks = spark.range(0, 1000).select(F.lit("a").alias("run_id"), F.col("id").alias("chunk_id"))
    seen, topics = replies.topics_seen(chunks, reg)
    assert {r["chunk_id"]: r["n_seen"] for r in seen.collect()} == {c: min(100_000, 4000 * c) for c in range(1000)}
    assert topics.where("topic != concat('t', ordinal)").count() == 0
    got = replies.topics_visible(chunks, reg).where("chunk_id in (0, 1, 3, 999)").select("chunk_id", "topics_visible").collect()
    for r in got:
        n = min(100_000, 4000 * r["chunk_id"])
        assert r["topics_visible"] == (", ".join(f"t{k}" for k in range(n)) or "无")


def test_a_failing_labeler_fails_its_chunk_only(spark, tmp_path):
    calls = str(tmp_path)

    def fn(pdf):
        for c in pdf["chunk_id"]:
            with open(f"{calls}/{c}", "a") as f:
                f.write("x")
        if (pdf["chunk_id"] % 5 == 2).any():
            raise RuntimeError("no answer")
        out = pdf[["run_id", "chunk_id"]].assign(reply='{"analyses": []}')
        return out[out["chunk_id"] % 5 != 4]  # some get no reply

    text = spark.range(0, 20).select(F.lit("r").alias("run_id"), F.col("id").alias("chunk_id"), F.lit("1: x").alias("text"))
    got = replies.parse_replies(labelers.label_with(text.coalesce(1), fn, "topic", retries=2)).collect()
    assert {r["chunk_id"]: r["status"] for r in got} == {c: "call_failed" if c % 5 in (2, 4) else "ok" for c in range(20)}
    assert all(r["reply"].startswith("调用接口失败：") for r in got if r["status"] == "call_failed")
    assert {c: len((tmp_path / str(c)).read_text()) for c in (1, 2)} == {1: 2, 2: 4}  # once in the batch, then alone


def test_requests_of_one_busy_day(spark):
    # one day holds every post; the post at the next midnight belongs to the request, the one after it does not
    at = dt.datetime(2024, 1, 1)
    posts = [(k, at + dt.timedelta(minutes=k % 1440), f"word{k % 7} text") for k in range(3000)]
    posts += [(5000, dt.datetime(2024, 1, 2), "word1"), (5001, dt.datetime(2024, 1, 2, 0, 1), "word1"),
              (5002, dt.datetime(2024, 1, 3), "word1"), (5003, None, "word1")]
    reqs = [(r, f"word{r % 7}", dt.date(2024, 1, 1), 1 + r // 100) for r in range(200)] + [(999, "word1", None, 1)]
    got = feed.posts_for_requests(
        spark.createDataFrame(posts, "post_id long, posted_at timestamp_ntz, body string"),
        spark.createDataFrame(reqs, "request_id long, keyword string, start_date date, days int"))
    want = {(r, p) for r, kw, day, n in reqs if day for p, t, body in posts
            if t and kw in body and at <= t <= at + dt.timedelta(days=n)}
    rows = [(x["request_id"], x["post_id"]) for x in got.select("request_id", "post_id").collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert (1, 5000) in want and (1, 5001) not in want and (106, 5001) in want and (106, 5002) in want


def test_fields_of_real_markup(spark):
    html = ('<div class="x"><div class="card-wrap" action-type="feed_list_item"><a nick-name="other">o</a>'
            '<p class="txt" node-type="feed_list_content" nick-name="A &amp; B">&nbsp;caf&#233; &#x4E2D;<br/>&#38;lt; &amp;#39;</p>'
            '<div class="from s"> <a>2024-01-02 03:04</a> 来自<a>phone</a></div>'
            '<div id="k" class="card-act y"><ul><li><div>1</div></li><li class="q"><span>2</span></li><li>3</li></ul></div></div>'
            '<div action-type="feed_list_item" class="card-wrap"><p node-type="feed_list_content">no more</p></div></div>')
    pages = spark.createDataFrame([(1, 1, "k", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 31), html)],
                                  "page_id long, page_no int, keyword string, win_start timestamp_ntz, win_end timestamp_ntz, "
                                  "fetched_at timestamp_ntz, html string")
    a, b = feed.extract_posts(pages).orderBy("item_no").collect()
    assert (a.author, a.body, a.posted_raw, a.via) == ("A & B", "café 中&lt; &#39;", "2024-01-02 03:04", "phone")
    assert (a.reposts_raw, a.comments_raw, a.likes_raw) == ("1", "2", "3")
    assert a.posted_at == dt.datetime(2024, 1, 2, 3, 4)
    assert (b.author, b.body, b.posted_raw, b.via, b.reposts_raw) == (None, "no more", "", "无", None)


PAGE_SCHEMA = ("page_id long, page_no int, keyword string, win_start timestamp_ntz, win_end timestamp_ntz, "
               "fetched_at timestamp_ntz, html string")


def _extracted(spark, html):
    day = [dt.datetime(2024, 1, d) for d in (1, 3, 31)]
    return feed.extract_posts(spark.createDataFrame([(1, 1, "k", *day, html)], PAGE_SCHEMA)).orderBy("item_no").collect()


def test_elements_end_at_their_own_closing_tag(spark):
    item = ("<div class='card-wrap' action-type='feed_list_item'><div><div class=from-other>no</div>"
            "<P class=txt nick-name='O x' node-type=feed_list_content>short</P>"
            "<p node-type='feed_list_content_full' title='a > b'>long <p>inner</p> <b>text</b> a < b<!-- no <p> --></p>"
            "<div class='x from y'><div><a>2024-01-02 03:04</a></div><div> 来自 <div><a>phone</a></div></div></div></div>"
            "<div class=card-act><ul><li><div>7</div></li><li class='n'><ul><li>8</li></ul></li></ul></div>"
            "<div class='footer'><ul><li>About</li><li>Help</li></ul></div></div>"
            "<div class='from'>2024-01-09 来自 page</div><div class='card-act'><li>99</li></div>")
    a, b = _extracted(spark, f"<html><div>{item}<div action-type=feed_list_item><p node-type=feed_list_content "
                             f"nick-name=B>open body<div class=\"from\">今天</div></div></div></html>")
    assert (a.author, a.body) == ("O x", "long inner text a < b")
    assert (a.posted_raw, a.via) == ("2024-01-02 03:04", "phone")
    assert (a.reposts_raw, a.comments_raw, a.likes_raw) == ("7", "8", "8")  # the third <li> stands inside the second
    assert (b.author, b.posted_raw, b.via, b.reposts_raw) == ("B", "今天", "无", None)
    assert b.body.startswith("open body")


def test_markup_without_any_part(spark):
    for html in ("", "<p>no items</p>", "<div class=\"feed_list_item\">x</div>", None):
        assert _extracted(spark, html) == []
    (row,) = _extracted(spark, '<div action-type="feed_list_item"></div><ul><li>1</li></ul>')
    assert (row.author, row.posted_raw, row.via, row.body, row.reposts_raw) == (None, "", "无", "", None)


def test_keywords_are_found_through_their_rarest_piece(spark):
    """One day, 5,000 requests: the same rows as testing every pair, keywords of every length, no pair join."""
    at = dt.datetime(2024, 1, 1, 12)
    bodies = [f"post {k} about the thing number{k % 50} 今天天气 \U0001F600{k % 3}" for k in range(400)] + [None, "", "x"]
    posts = [(None if k % 5 == 0 else k % 7, at if k % 11 else None, b) for k, b in enumerate(bodies)]
    words = [f"number{k}" for k in range(60)] + ["the thing", "天气", "天", "\U0001F6001", "", "x", "zz", "absent words", "t 1", None]
    reqs = [(r, words[r % len(words)], at.date(), 1) for r in range(5000)]
    got = feed.posts_for_requests(spark.createDataFrame(posts, "post_id long, posted_at timestamp_ntz, body string").repartition(4),
                                  spark.createDataFrame(reqs, "request_id long, keyword string, start_date date, days int"))
    found = got.groupBy("request_id").count().collect()
    want = {r: sum(t is not None and b is not None and kw in b for _, t, b in posts) for r, kw, *_ in reqs if kw is not None}
    assert {r["request_id"]: r["count"] for r in found} == {r: n for r, n in want.items() if n}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = feed.posts_for_requests(spark.createDataFrame(posts, "post_id long, posted_at timestamp_ntz, body string"),
                                   spark.createDataFrame([], "request_id long, keyword string, start_date date, days int"))
    assert none.count() == 0 and none.columns == got.columns


def test_posts_are_made_and_cut_once(spark):
    """The plan behind the posts runs once, whatever the keywords' lengths; only what was written of it is read again."""
    made = spark.sparkContext.accumulator(0)

    def rows(k):
        made.add(1)
        return k, dt.datetime(2024, 1, 1 + k % 3, 12), f"post {k} on the thing number{k % 4}"

    posts = spark.createDataFrame(spark.sparkContext.parallelize(range(60), 3).map(rows), "post_id long, posted_at timestamp_ntz, body string")
    reqs = [(r, kw, dt.date(2024, 1, 1), 1) for r, kw in enumerate(["number1", "th", "1", "", "thing number9"])]
    got = feed.posts_for_requests(posts, spark.createDataFrame(reqs, "request_id long, keyword string, start_date date, days int"))
    day = [k for k in range(60) if k % 3 == 0]
    want = {(r, k) for r, kw, *_ in reqs for k in day if kw in f"post {k} on the thing number{k % 4}"}
    found = [tuple(x) for x in got.select("request_id", "post_id").collect()]
    assert len(found) == len(want) and set(found) == want
    assert made.value == 60
    assert "ExistingRDD" not in got._jdf.queryExecution().executedPlan().toString()


def test_requests_move_first_tokens_only(spark):
    """The builder of the requests takes a text's first token before the texts meet the events."""
    plan = fixtures.requests(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("lower(text")


def _tables(spark, root, docs, events):
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
                               ("events", events, "event_id long, ts timestamp_ntz")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_entries_of_documents_with_several_events(spark, tmp_path):
    """Bodies lie once per document, whatever number of events it has; every post is an entry of its own."""
    docs = [(1, "was it", "en", "a", 6), (2, None, "en", "b", 0), (None, "der x", "de", "a", 5), (1, "are from", "en", "c", 8)]
    events = [(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 2)), (None, dt.datetime(2024, 1, 3)), (9, dt.datetime(2024, 1, 4))]
    root = _tables(spark, tmp_path, docs, events)
    e = fixtures.entry_rows(spark, root)
    assert e.bodies.count() == len(docs) == e.bodies.select("_row").distinct().count()
    got = fixtures.entries(spark, root).collect()
    assert sorted((x.chunk_id, x.entry_no) for x in got) == [(0, k) for k in range(1, 7)]
    want = [(1, "was it", "positive", ["t_it"])] * 2 + [(1, "are from", "negative", ["t_from"])] * 2
    want += [(2, None, "neutral", []), (None, "der x", "negative", [])]
    assert sorted(map(repr, want)) == sorted(repr((x.post_id, x.body, x.sentiment, x.topics_arr)) for x in got)


def test_both_runs_of_the_post_sink_read_one_set_of_posts(spark, tmp_path, monkeypatch):
    made = []
    posts = fixtures.posts
    monkeypatch.setattr(fixtures, "posts", lambda *args, **kw: made.append(1) or posts(*args, **kw))
    docs = [(k, None if k == 3 else f"text {k}", "en", "a", 6) for k in range(12)]
    root = _tables(spark, tmp_path, docs, [(k, dt.datetime(2024, 1, 1, 2 * k)) for k in range(10)])
    # posts without a text (3), or without a time where it is shown (11), are no items of a page
    got = q_io.q_sink_append_posts(spark, root).groupBy("run_id", "part_id").count().collect()
    assert len(made) == 1
    assert {(x["run_id"], x["part_id"]): x["count"] for x in got} == {
        ("table", "0"): 4, ("table", "1"): 4, ("table", "2"): 2, ("table", "none"): 2, ("feed", "0"): 9, ("feed", "1"): 1}


def test_reports_with_absent_sections(spark):
    events = spark.createDataFrame([(1, "#a#"), (2, "#b#")], "request_id long, event_keyword string")
    given = spark.createDataFrame([(1, "text")], "request_id long, text string")
    for k, name in enumerate(("sentiment", "topic", "table")):
        for sections in ({name: given}, {n: given for n in ("sentiment", "topic", "table") if n != name}):
            got = {r["request_id"]: r["text"] for r in report.event_report(events, **sections).collect()}
            assert got[2].count("无") == 3
            parts = got[1].split("】:\n")[1:]
            assert [p.startswith("text") for p in parts] == [n in sections for n in ("sentiment", "topic", "table")]


def test_a_failed_state_read_is_an_error(spark, tmp_path):
    late = jobs.split_late(*(str(tmp_path / n) for n in ("out", "late", "max")), delay_seconds=1)
    with pytest.raises(AnalysisException):
        late(spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz"), 1)


def test_rows_outside_the_asked_window_late_ones_and_repeats(spark, tmp_path):
    def t(day, hour=0, minute=0):
        return dt.datetime(2024, 1, day, hour, minute)

    asked = spark.createDataFrame([(1, t(2), t(4)), (2, t(1), t(9))], "request_id long, win_start timestamp_ntz, win_end timestamp_ntz")
    schema = "request_id long, post string, ts timestamp_ntz"
    # Request 1's post of the 6th is outside its window and still moves the watermark to the 5th.
    parts = [[(1, "edge", t(2)), (1, "last", t(4)), (1, "past", t(4, 0, 1)), (1, "far", t(6)), (2, "a", t(3)), (2, "a", t(3)), (3, "nobody", t(3)),
              (None, "none", t(9)), (2, "no time", None)],
             [(2, "late", t(5)), (2, "late", t(5)), (2, "soon", t(5, 0, 1)), (2, "a", t(3)), (1, "edge", t(2)), (1, "early", t(1))],
             [(2, "soon", t(5, 0, 1)), (2, "new", t(9))]]
    landing, out, dropped = str(tmp_path / "landing"), str(tmp_path / "out"), 0
    for part in parts:  # each starts again from the checkpoint: window, keys and watermark are the query's own state
        jobs.land(spark.createDataFrame(part, schema).coalesce(1), landing)
        stream = jobs.read_landed(spark, landing, spark.createDataFrame([], schema).schema)
        for p in jobs.run_available(jobs.rows_in_time(stream, asked, "post", "1 day"), lambda b, i: jobs.write_batch(b, out, i),
                                    str(tmp_path / "checkpoint")):
            dropped += sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
    in_time = spark.read.parquet(out)
    assert sorted(r.post for r in in_time.collect()) == ["a", "edge", "last", "new", "soon"]
    got = {(r.request_id, r.post): (r.n_rows, r.fate) for r in jobs.fates(spark.read.parquet(landing), asked, in_time, "post").collect()}
    assert got == {(1, "edge"): (2, "on_time"), (1, "last"): (1, "on_time"), (1, "past"): (1, "outside"), (1, "far"): (1, "outside"),
                   (2, "a"): (3, "on_time"), (3, "nobody"): (1, "outside"), (None, "none"): (1, "outside"), (2, "no time"): (1, "outside"),
                   (2, "late"): (2, "late"), (2, "soon"): (2, "on_time"), (1, "early"): (1, "outside"), (2, "new"): (1, "on_time")}
    assert dropped == 4  # both late rows, and the two repeats that came behind the watermark: Spark's own count


def test_state_table_over_fifty_batches_with_replays(spark, tmp_path):
    total = state.StateTable(spark, str(tmp_path / "sum"), "k string, n long", state.sum_per_key(["k"], ["n"]), every=7)
    last = state.StateTable(spark, str(tmp_path / "last"), "k string, n long", state.last_per_key(["k"], ["n"]), every=7)
    want_sum, want_last = {}, {}
    assert total.read().count() == 0
    for b in range(50):
        rows = [(f"k{b % 5}", b), ("all", 1)]
        delta = spark.createDataFrame(rows, "k string, n long").coalesce(1)
        for _ in range(2 if b in (3, 6, 20, 48) else 1):  # replays, also of batches that compact
            total.write(delta, b)
            if b < 16:
                last.write(delta, b)
        for k, n in rows:
            want_sum[k], want_last[k] = want_sum.get(k, 0) + n, n
        assert total.folders_read() <= 8
        if b in (0, 6, 7, 20, 49):
            assert {r["k"]: r["n"] for r in total.read().collect()} == want_sum
        if b in (6, 15):
            assert {r["k"]: r["n"] for r in last.read().collect()} == want_last
    assert len(list((tmp_path / "sum" / "delta").iterdir())) + len(list((tmp_path / "sum" / "snapshot").iterdir())) <= 17
    assert {r["k"]: r["n"] for r in total.read(before=49).collect()} == {**want_sum, "k4": want_sum["k4"] - 49, "all": 49}


def test_registry_stream_restarts_from_its_checkpoint(spark, tmp_path):
    """Keyed state: later batches, also out of order, leave one first sighting per topic."""
    schema = "run_id string, chunk_id long, entry_idx int, topic_pos int, topic string"
    registry = jobs.registry_table(spark, str(tmp_path / "registry"), every=2)
    parts = [[("r", 5, 0, 0, "a"), ("r", 5, 0, 1, "b"), ("r", 5, 1, 0, "a")], [("r", 6, 0, 0, "b"), ("r", 6, 0, 1, "c"), ("s", 6, 0, 0, "a")],
             [("r", 1, 2, 0, "c"), ("r", 9, 0, 0, "d")]]
    for part in parts:
        jobs.land(spark.createDataFrame(part, schema), str(tmp_path / "landing"))
        stream = jobs.read_landed(spark, str(tmp_path / "landing"), spark.createDataFrame([], schema).schema)
        jobs.run_available(jobs.first_sightings(stream), registry.write, str(tmp_path / "checkpoint"), "update")
    assert sorted(map(tuple, registry.read().collect())) == [
        ("r", "a", 5, 0, 0), ("r", "b", 5, 0, 1), ("r", "c", 1, 2, 0), ("r", "d", 9, 0, 0), ("s", "a", 6, 0, 0)]


def test_labelling_rounds_show_the_topics_of_earlier_ones(spark, tmp_path):
    def fn(pdf):
        out = []
        for chunk, prompt in zip(pdf["chunk_id"], pdf["text"]):
            if chunk == 2:
                raise ValueError("down")
            shown = prompt.rpartition(replies.TOPIC_PROMPT_LIST)[2].strip()
            out.append(json.dumps({"analyses": [{"entry": "1", "topics": [shown if shown != "无" else "none", f"t{chunk}"]}]}))
        return pdf[["run_id", "chunk_id"]].assign(reply=out)

    registry = jobs.registry_table(spark, str(tmp_path / "registry"))
    step = jobs.labelling_step(registry, str(tmp_path / "replies"), fn, retries=0)
    for batch_id, chunks in enumerate([[0, 1], [2, 3], [2, 3], [4]]):
        step(spark.createDataFrame([("r", c, "1: text") for c in chunks], "run_id string, chunk_id long, text string"),
             {0: 0, 1: 1, 2: 1, 3: 2}[batch_id])  # the second round is replayed
    parsed = replies.parse_replies(spark.read.parquet(str(tmp_path / "replies")))
    got = {r["chunk_id"]: (r["status"], [t for a in r["analyses"] or [] for t in a["topics"]]) for r in parsed.collect()}
    seen = "none, t0, t1"
    assert got == {0: ("ok", ["none", "t0"]), 1: ("ok", ["none", "t1"]), 2: ("call_failed", []), 3: ("ok", [seen, "t3"]),
                   4: ("ok", [f"{seen}, {seen}, t3", "t4"])}


def test_parts_of_a_run_add_up_and_a_repeated_part_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a\nb", "r1", "0"), (2, "c", "r1", "1"), (3, "d", "r2", "0"), (4, "e", "r1", "0")],
                                 "entry_no int, body string, run_id string, part_id string")
    path = str(tmp_path / "runs")
    for run, part in (("r1", "0"), ("r2", "0"), ("r1", "1"), ("r1", "0"), ("r1", "1")):
        files.append_csv(rows.where((F.col("run_id") == run) & (F.col("part_id") == part)), path)
    got = files.read_csv(spark, path, rows.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    files.append_csv(spark.createDataFrame([(9, "new", "r1", "1")], rows.schema), path)
    assert sorted(r["entry_no"] for r in files.read_csv(spark, path, rows.schema).collect()) == [1, 3, 4, 9]


def test_a_flat_folder_of_templates_and_images(spark, tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    (folder / "hello.txt").write_text("line 1\nline 2", encoding="utf-8")
    (folder / "empty.txt").write_text("")
    (folder / "broken.txt").write_bytes(b"caf\xe9 \xff")
    (folder / "gone.txt").write_text("was here")
    found, images = files.read_templates(spark, str(folder)), files.read_images(spark, str(folder))
    (folder / "gone.txt").unlink()  # after it was listed
    wanted = spark.createDataFrame([(n,) for n in ("hello", "empty", "broken", "gone", "never")], "name string")
    got = {r["name"]: (r["body"], r["is_default"]) for r in files.templates_with_default(wanted, found).collect()}
    assert got == {"hello": ("line 1\nline 2", False), **{n: (files.DEFAULT_TEMPLATE, True) for n in ("broken", "gone", "never")},
                   "empty": got["empty"]}
    parts = {r["name"]: [p["url"] for p in r["parts"]] for r in files.message_parts(
        wanted.withColumn("text", F.lit("see")), images).collect()}
    assert parts["hello"] == [None, "data:image/jpeg;base64,bGluZSAxCmxpbmUgMg=="]
    assert parts["broken"] == [None, "data:image/jpeg;base64,Y2Fm6SD/"] and parts["gone"] == parts["never"] == [None]


def test_files_written_side_by_side(spark, tmp_path):
    rows = spark.range(0, 50).select(F.concat(F.lit("f"), F.col("id"), F.lit(".txt")).alias("name"),
                                     F.encode(F.concat(F.lit("text "), F.col("id")), "UTF-8").alias("content"))
    files.write_files(rows, str(tmp_path / "out"))
    files.write_files(rows.where("name = 'f1.txt'"), str(tmp_path / "out"))
    got = {r["name"]: r["body"] for r in files.read_templates(spark, str(tmp_path / "out")).collect()}
    assert got == {f"f{k}": f"text {k}" for k in range(50)}


def test_merge_hot_key_emits_no_pairs(spark):
    # one key holds every row on both sides: the result has one row per (left row, distinct sentiment)
    topics = spark.range(0, 2000).select(F.lit(1).alias("entry_no"), F.lit("same").alias("body"),
                                         F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("topics"))
    sent = spark.range(0, 3000).select(F.lit(1).alias("entry_no"), F.lit("same").alias("body"),
                                       F.when(F.col("id") % 2 == 0, "positive").otherwise("negative").alias("sentiment"))
    m = merge.merge_labels(topics, sent)
    assert m.count() == 2000 * 2
    assert m.agg(F.sum("n")).first()[0] == 2000 * 3000
    counts = {r["topic"]: r["total"] for r in merge.topic_sentiment_counts(merge.topic_mentions(m)).collect()}
    assert sum(counts.values()) == 2000 * 3000


def test_history_of_one_long_conversation_with_ties(spark):
    """A third of all rows in one conversation, equal turns, NULL and repeated rows: every message has one number."""
    long = [(1, k // 3, ("user", "assistant", "user")[k % 3], f"m{k}") for k in range(300)]
    rows = long + [(2, 0, "user", "a"), (2, 0, "user", "a"), (2, None, "assistant", None), (None, 1, "user", "n"), (3, 5, None, "x")]
    rows += [(k, 0, "user", "hi") for k in range(10, 600)]
    got = conversation_history(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5), "SYS").collect()
    by_conv = {}
    for r in got:
        by_conv.setdefault(r["conv_id"], []).append(tuple(r)[1:])
    assert set(by_conv) == {r[0] for r in rows} and len(got) == len(rows) + len(by_conv)
    for conv, messages in by_conv.items():
        messages.sort()
        assert [m[0] for m in messages] == list(range(len(messages))) and messages[0][1:] == ("system", "SYS", None)
        calls = [m[3] for m in messages if m[1] == "user"]
        assert calls == list(range(1, len(calls) + 1)) and all(m[3] is None for m in messages if m[1] != "user")
    turns = {text: turn for _, turn, _, text in long}
    order = [(turns[m[2]], m[1]) for m in by_conv[1][1:]]
    assert order == sorted(order)
    assert [m[2] for m in by_conv[2]] == ["SYS", None, "a", "a"]
