"""Scalar functions on hand rows: F1 feed time, F2 fence, F5 unicode trim, F7/F8 topics, F9, F19."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from opinio.functions.feedtime import parse_feed_time
from opinio.functions.text import (first_token, hashtags, join_topics, split_topics, strip_char, strip_fence,
                                   tokens, unescape_html, utrim, without_hashtags)

REF = dt.datetime(2024, 5, 6, 7, 8, 9)

# The F1 rows of FIXTURES.md (input -> expected with the reference time above).
TIME_ROWS = [
    ("2022年03月14日 00:57", dt.datetime(2022, 3, 14, 0, 57)),
    ("03月14日00:57", dt.datetime(2024, 3, 14, 0, 57)),
    ("22年3月14日 1:5", dt.datetime(2024, 3, 14, 1, 5)),
    ("刚刚", REF),
    ("今天08:30", REF),
    ("2022-03-14 00:57", dt.datetime(2022, 3, 14, 0, 57)),
    ("2022-3-4 0:7", dt.datetime(2022, 3, 4, 0, 7)),
    ("2022-03-14", dt.datetime(2022, 3, 14)),
    ("今天 08:30", dt.datetime(2024, 5, 6, 8, 30)),
    ("5分钟前", dt.datetime(2024, 5, 6, 7, 3, 9)),
    ("3 小时前", dt.datetime(2024, 5, 6, 4, 8, 9)),
    ("昨天 08:30", None),
    ("", None),
    ("2022-03-14 00:57:11", None),
    ("13月40日 00:57", None),
    ("今天 25:99", None),
]


def test_feed_time_rules(spark):
    df = spark.createDataFrame([(s,) for s, _ in TIME_ROWS], "s string")
    out = df.select("s", parse_feed_time(F.col("s"), F.lit(REF).cast("timestamp_ntz")).alias("t")).collect()
    got = {r["s"]: r["t"] for r in out}
    for s, want in TIME_ROWS:
        assert got[s] == want, s


def test_utrim_matches_python_strip(spark):
    rows = ["　 a　", "\t\n", "a b", None, "\xa0x ", "plain"]
    out = spark.createDataFrame([(s,) for s in rows], "s string").select(utrim("s").alias("t")).collect()
    assert [r["t"] for r in out] == [None if s is None else s.strip() for s in rows]


def test_strip_fence(spark):
    rows = [
        ('Here:\n```json\n{"a": 1}\n```\nbye', '{"a": 1}'),
        ('  {"b": 2}  ', '{"b": 2}'),
        ("```json\n{\"a\": {\"c\": 1}}``` and ```json\n{\"d\": 2}\n```", '{"a": {"c": 1}}``` and ```json\n{"d": 2}'),
        ("调用接口失败：timeout", "调用接口失败：timeout"),
    ]
    df = spark.createDataFrame(rows, "s string, want string")
    for r in df.select(strip_fence("s").alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_topic_split_and_join(spark):
    df = spark.createDataFrame([("t1, t2 ,, ，t3",), ("  ",), (None,)], "s string")
    out = df.select(split_topics("s").alias("a"), join_topics(split_topics("s"), "无").alias("j")).collect()
    assert out[0]["a"] == ["t1", "t2", "，t3"]
    assert out[0]["j"] == "t1, t2, ，t3"
    assert out[1]["a"] == [] and out[1]["j"] == "无"


def test_strip_char_hashtags_tokens(spark):
    df = spark.createDataFrame([("#a# x #b#",), ("no tag",), ("#open",)], "s string")
    out = df.select(hashtags("s").alias("h"), without_hashtags("s").alias("w"), strip_char("s", "#").alias("c"),
                    tokens("s").alias("t"), first_token("s").alias("f")).collect()
    assert [r["h"] for r in out] == [["a", "b"], [], []]
    assert [r["c"] for r in out] == ["a# x #b", "no tag", "open"]
    assert out[0]["w"] == "x"
    assert [r["f"] for r in out] == [r["t"][0] if r["t"] else None for r in out]


def test_tokens_of_every_script(spark):
    rows = [("Für die Straße, ÉTÉ 12 don't", ["für", "die", "straße", "été", "don", "t"]), ("今天天气 good", ["今天", "天天", "天气", "good"]),
            ("中", ["中"]), ("", []), ("привет 世界x", ["привет", "世界", "界x"])]
    got = spark.createDataFrame([(s,) for s, _ in rows], "s string").select(tokens("s").alias("t"), first_token("s").alias("f")).collect()
    assert [r["t"] for r in got] == [t for _, t in rows]
    assert [r["f"] for r in got] == [t[0] if t else None for _, t in rows]


def test_entities(spark):
    rows = [("a&nbsp;b", "a\xa0b"), ("&#233;&#x4e2d;&#38;lt;", "é中&lt;"), ("&amp;#39; &amp;lt;", "&#39; &lt;"), ("&#; &#xZ; &#99999999;", "&#; &#xZ; &#99999999;"),
            ("&#128512;!", "\U0001F600!"), ("plain &unknown;", "plain &unknown;"), (None, None)]
    got = spark.createDataFrame(rows, "s string, want string").select(unescape_html("s").alias("t"), "want").collect()
    assert [r["t"] for r in got] == [r["want"] for r in got]
