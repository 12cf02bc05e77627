"""Analysis requests: validate an extractor's JSON answer (P13-P15, F9, F10, O2) and
extract the fields from free text (M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import strip_char, strip_fence

# The keys a complete request has and the accepted platform words.
REQUIRED_KEYS = ["event_keywords", "start_year", "start_month", "start_day", "event_release_platform"]
PLATFORMS = ["weibo", "微博"]

# Free-text patterns (ours) for the request extractor.
HASHTAG = "#([^#]+)#"
ISO_DATE = r"(\d{4})-(\d{1,2})-(\d{1,2})"
CJK_DATE = r"(\d{4})年(\d{1,2})月(\d{1,2})日"
PLATFORM_WORD = "(?i)(weibo|微博)"


def _field(clean: Column, key: str) -> Column:
    return F.get_json_object(clean, f"$.{key}")


def validate_requests(reqs: DataFrame, reply_col: str = "reply", days: Column | int = 1) -> DataFrame:
    """Add status (ok / not_json / incomplete / unsupported_platform / bad_date / no_keyword),
    keyword (first keyword without '#'), start_date and days (a number, or a column with each request's own)."""
    clean = strip_fence(F.col(reply_col))
    is_json = F.try_parse_json(clean).isNotNull()
    keys = F.json_object_keys(clean)
    complete = F.size(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), keys)) == 0
    platform_ok = F.lower(_field(clean, "event_release_platform")).isin(*PLATFORMS)
    y, m, d = (_field(clean, k).try_cast("int") for k in ("start_year", "start_month", "start_day"))
    ek = _field(clean, "event_keywords")
    kws = F.coalesce(F.from_json(ek, "array<string>"),
                     F.when(ek.isNotNull() & ~ek.startswith("["), F.array(ek)))
    status = (F.when(~is_json, F.lit("not_json"))
              .when(~F.coalesce(complete, F.lit(False)), F.lit("incomplete"))
              .when(~F.coalesce(platform_ok, F.lit(False)), F.lit("unsupported_platform"))
              .when(y.isNull() | m.isNull() | d.isNull(), F.lit("bad_date"))
              .when(F.coalesce(F.size(kws), F.lit(0)) < 1, F.lit("no_keyword"))
              .otherwise(F.lit("ok")))
    ok = status == "ok"
    return reqs.select(
        "*", status.alias("status"),
        F.when(ok, strip_char(F.get(kws, 0), "#")).alias("keyword"),
        F.when(ok, F.get(kws, 0)).alias("event_keyword"),
        F.when(ok, F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")).alias("start_date"),
        (days if isinstance(days, Column) else F.lit(days)).cast("int").alias("days"))


def request_fields(reqs: DataFrame, text_col: str = "text") -> DataFrame:
    """M4: keywords, start date and platform found in free text, plus what is missing."""
    t = F.col(text_col)
    tags = F.regexp_extract_all(t, F.lit(HASHTAG), 1)
    iso = t.rlike(ISO_DATE)
    cjk = t.rlike(CJK_DATE)

    def part(i):
        return F.when(iso, F.regexp_extract(t, ISO_DATE, i)).when(cjk, F.regexp_extract(t, CJK_DATE, i)) \
            .try_cast("int").cast("string")

    kw = F.when(F.size(tags) > 0, F.array_join(F.transform(tags, lambda x: F.concat(F.lit("#"), x, F.lit("#"))), ","))
    platform = F.nullif(F.regexp_extract(t, PLATFORM_WORD, 1), F.lit(""))
    cols = {"event_keywords": kw, "start_year": part(1), "start_month": part(2), "start_day": part(3),
            "event_release_platform": platform}
    missing = F.array_join(F.filter(F.array(*[F.when(v.isNull(), F.lit(k)) for k, v in cols.items()]),
                                    lambda x: x.isNotNull()), ",")
    return reqs.select("request_id", *[v.alias(k) for k, v in cols.items()], missing.alias("missing"))
