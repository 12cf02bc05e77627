"""feed time text -> timestamp_ntz, first matching rule wins, NULL otherwise.

"Now" is an explicit column (the page's fetch time), never the wall clock, so a
rerun gives the same answer. A rule whose pattern matches but whose date is not
valid (month 13, hour 25) gives NULL. Digits are ASCII digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinio.functions.text import WS_CLASS

_S = WS_CLASS + "*"      # optional whitespace
_S1 = WS_CLASS + "+"     # at least one whitespace

# The eight accepted shapes, in the order they are tried.
RULE_YMD_HM = r"(\d{4})年(\d{1,2})月(\d{1,2})日" + _S + r"(\d{1,2}):(\d{1,2})"
RULE_MD_HM = r"(\d{1,2})月(\d{1,2})日" + _S + r"(\d{1,2}):(\d{1,2})"
WORD_JUST_NOW = "刚刚"
# whole-string "%Y-%m-%d %H:%M" with the field shapes a strptime call accepts
RULE_ISO_HM = (r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])" + _S1
               + r"(2[0-3]|[0-1]\d|\d):([0-5]\d|\d)$")
RULE_ISO_DAY = r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"
WORD_TODAY = "今天"
RULE_TODAY_HM = "今天" + _S1 + r"(\d{1,2}):(\d{1,2})"
RULE_MINUTES_AGO = r"(\d+)" + _S + "分钟前"
RULE_HOURS_AGO = r"(\d+)" + _S + "小时前"


def _grp(s: Column, pattern: str, i: int) -> Column:
    return F.regexp_extract(s, pattern, i).try_cast("int")


def _ts(y, m, d, h, mi) -> Column:
    return F.try_make_timestamp_ntz(y, m, d, h, mi, F.lit(0))


def parse_feed_time(text, ref_ts) -> Column:
    """Parse ``text`` (feed time wording) relative to ``ref_ts`` (timestamp_ntz)."""
    s = F.col(text) if isinstance(text, str) else text
    ref = (F.col(ref_ts) if isinstance(ref_ts, str) else ref_ts).cast("timestamp_ntz")
    g = lambda p, i: _grp(s, p, i)
    n_min = F.regexp_extract(s, RULE_MINUTES_AGO, 1).try_cast("int")
    n_hour = F.regexp_extract(s, RULE_HOURS_AGO, 1).try_cast("int")
    today = F.when(
        s.rlike(RULE_TODAY_HM),
        _ts(F.year(ref), F.month(ref), F.dayofmonth(ref), g(RULE_TODAY_HM, 1), g(RULE_TODAY_HM, 2)),
    ).otherwise(ref)
    return (
        F.when(s.rlike(RULE_YMD_HM),
               _ts(g(RULE_YMD_HM, 1), g(RULE_YMD_HM, 2), g(RULE_YMD_HM, 3), g(RULE_YMD_HM, 4), g(RULE_YMD_HM, 5)))
        .when(s.rlike(RULE_MD_HM),
              _ts(F.year(ref), g(RULE_MD_HM, 1), g(RULE_MD_HM, 2), g(RULE_MD_HM, 3), g(RULE_MD_HM, 4)))
        .when(s.contains(WORD_JUST_NOW), ref)
        .when(s.rlike(RULE_ISO_HM),
              _ts(g(RULE_ISO_HM, 1), g(RULE_ISO_HM, 2), F.btrim(F.regexp_extract(s, RULE_ISO_HM, 3)).try_cast("int"),
                  g(RULE_ISO_HM, 4), g(RULE_ISO_HM, 5)))
        .when(s.rlike(RULE_ISO_DAY),
              _ts(g(RULE_ISO_DAY, 1), g(RULE_ISO_DAY, 2), F.btrim(F.regexp_extract(s, RULE_ISO_DAY, 3)).try_cast("int"),
                  F.lit(0), F.lit(0)))
        .when(s.contains(WORD_TODAY), today)
        .when(s.rlike(RULE_MINUTES_AGO), ref - F.make_dt_interval(F.lit(0), F.lit(0), n_min, F.lit(0)))
        .when(s.rlike(RULE_HOURS_AGO), ref - F.make_dt_interval(F.lit(0), n_hour, F.lit(0), F.lit(0)))
    ).cast("timestamp_ntz")


def hour_text_to_ts(c) -> Column:
    """``%Y-%m-%d-%H`` text -> timestamp_ntz."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd-HH"))


def ts_to_hour_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd-HH")


def run_stamp(c) -> Column:
    """``%Y%m%d%H%M%S`` stamp."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyyMMddHHmmss")


def ts_text(c) -> Column:
    """Timestamps leave queries as ``yyyy-MM-dd HH:mm:ss`` text (engine-neutral)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
