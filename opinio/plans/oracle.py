"""Independent DuckDB SQL for every exactly-checked query.

labelers use unnest + join + group by, the numbering a plain window, the feed
extraction string splits, and so on. The tables are the pre-registered views.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# is imported, so a wrong rule there shows up as a difference.

# Every character for which Python's str.isspace() holds.
SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PY_WHITESPACE = "".join(map(chr, SPACES))
_S = "[" + PY_WHITESPACE + "]"

# A reply's JSON fence, and the system message of a request conversation.
FENCE_PATTERN = "(?s)```json" + _S + r"*(\{.*\})" + _S + "*```"
SYSTEM_MESSAGE = "Extract the event keywords, start date and platform of the request as JSON."

# The shapes of a feed time.
RULE_YMD_HM = r"(\d{4})年(\d{1,2})月(\d{1,2})日" + _S + r"*(\d{1,2}):(\d{1,2})"
RULE_MD_HM = r"(\d{1,2})月(\d{1,2})日" + _S + r"*(\d{1,2}):(\d{1,2})"
_YMD = r"^(\d{4})-(0[1-9]|1[0-2]|[1-9])-(0[1-9]|[12]\d|3[01]|[1-9]| [1-9])"
RULE_ISO_HM = _YMD + _S + r"+([01]\d|2[0-3]|\d):([0-5]\d|\d)$"
RULE_ISO_DAY = _YMD + "$"
RULE_TODAY_HM = "今天" + _S + r"+(\d{1,2}):(\d{1,2})"
RULE_MINUTES_AGO = r"(\d+)" + _S + "*分钟前"
RULE_HOURS_AGO = r"(\d+)" + _S + "*小时前"

# Lexicon, taxonomy and stop list of FIXTURES.md.
LEXICON = [("as", 1.0), ("was", 1.0), ("les", 1.0), ("por", 1.0), ("are", -1.0), ("inst", -1.0), ("der", -1.0),
           ("del", -1.0)]
TAXONOMY = [("t_it", "it"), ("t_from", "from"), ("t_sich", "sich"), ("t_pour", "pour"), ("t_para", "para"),
            ("t_this", "this")]
STOP_TOPICS = ["t_this"]
# A token is a run of letters; the test tables hold no Chinese text, whose bigrams tests/test_functions.py checks.
LETTERS = r"\p{L}+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = _q(PY_WHITESPACE)


def trim_u(x: str) -> str:
    return f"trim({x}, {WS})"


LEX = "lex(term, weight) AS (VALUES " + ", ".join(f"({_q(t)}, {w})" for t, w in LEXICON) + ")"
TAX = "tax(topic, term) AS (VALUES " + ", ".join(f"({_q(a)}, {_q(b)})" for a, b in TAXONOMY) + ")"
STOP = "stop(topic) AS (VALUES " + ", ".join(f"({_q(t)})" for t in STOP_TOPICS) + ")"

# documents labelled by lexicon and taxonomy
DOC_LABELS = f"""
{LEX}, {TAX},
dtok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{LETTERS}')) AS term FROM documents),
dscore AS (SELECT doc_id, sum(weight) AS s FROM dtok JOIN lex USING (term) GROUP BY doc_id),
dsent AS (SELECT d.doc_id, CASE WHEN coalesce(s, 0) > 0 THEN 'positive' WHEN coalesce(s, 0) < 0 THEN 'negative'
                 ELSE 'neutral' END AS sentiment
          FROM documents d LEFT JOIN dscore USING (doc_id)),
dtop AS (SELECT DISTINCT doc_id, topic FROM dtok JOIN tax USING (term)),
dment AS (SELECT t.doc_id, t.topic, s.sentiment FROM dtop t JOIN dsent s USING (doc_id))
"""

ORACLE["topic_sentiment"] = f"""
WITH {DOC_LABELS}
SELECT topic,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative,
       count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment IN ('negative', 'neutral', 'positive')) AS total
FROM dment GROUP BY topic
"""

ORACLE["topic_sentiment_ranked"] = f"""
WITH {DOC_LABELS},
ts AS ({ORACLE['topic_sentiment']})
SELECT *, row_number() OVER (ORDER BY total DESC, topic) AS rank FROM ts
"""

ORACLE["sentiment_lexicon"] = f"WITH {DOC_LABELS} SELECT doc_id, sentiment FROM dsent"

ORACLE["topics_taxonomy"] = f"""
WITH {DOC_LABELS}
SELECT d.doc_id, coalesce(string_agg(t.topic, ', ' ORDER BY t.topic), '') AS topics
FROM documents d LEFT JOIN dtop t USING (doc_id) GROUP BY d.doc_id
"""

ORACLE["sentiment_share"] = f"""
WITH {DOC_LABELS}
SELECT sentiment, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share
FROM dsent GROUP BY sentiment
"""

ORACLE["topic_share"] = f"""
WITH {DOC_LABELS}
SELECT topic, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM documents), 6) AS share_posts,
       round(count(*) / (SELECT count(*) FROM dtop), 6) AS share_mentions
FROM dtop GROUP BY topic
"""

ORACLE["topic_rollup"] = f"""
WITH {DOC_LABELS}
SELECT topic, sentiment, CAST(GROUPING(topic, sentiment) AS INTEGER) AS gid, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM dment), 6) AS share
FROM dment GROUP BY ROLLUP (topic, sentiment)
"""

ORACLE["topics_supported"] = f"""
WITH {DOC_LABELS}, {STOP}
SELECT topic, count(*) AS n FROM dtop
WHERE topic NOT IN (SELECT topic FROM stop)
GROUP BY topic HAVING count(*) >= 0.1 * (SELECT count(*) FROM documents)
"""


# ----------------------------------------------------------------- posts and chunks

POSTS = """
posts AS (
  SELECT d.doc_id AS post_id, CAST(d.doc_id % 49 + 1 AS INTEGER) AS page_no, d.source AS author,
         date_trunc('minute', e.ts) AS posted_at,
         CASE d.doc_id % 9
           WHEN 0 THEN strftime(date_trunc('minute', e.ts), '%Y年%m月%d日 %H:%M')
           WHEN 1 THEN strftime(date_trunc('minute', e.ts), '%m月%d日 %H:%M')
           WHEN 2 THEN strftime(date_trunc('minute', e.ts), '%Y-%m-%d %H:%M')
           WHEN 3 THEN strftime(date_trunc('minute', e.ts), '%Y-%m-%d')
           WHEN 4 THEN '刚刚'
           WHEN 5 THEN '今天 ' || strftime(date_trunc('minute', e.ts), '%H:%M')
           WHEN 6 THEN CAST(d.doc_id % 60 AS VARCHAR) || '分钟前'
           WHEN 7 THEN CAST(d.doc_id % 24 AS VARCHAR) || '小时前'
           ELSE '昨天 ' || strftime(date_trunc('minute', e.ts), '%H:%M') END AS posted_raw,
         CASE d.doc_id % 3 WHEN 1 THEN 'iPhone客户端' WHEN 2 THEN '微博网页版' END AS via,
         CAST(d.doc_id % 7 AS VARCHAR) AS reposts_raw, CAST(d.doc_id % 5 AS VARCHAR) AS comments_raw,
         CAST(d.doc_id % 11 AS VARCHAR) AS likes_raw, d.text AS body
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id)"""

POST_LABELS = f"""
{LEX}, {TAX}, {POSTS},
ptok AS (SELECT post_id, unnest(regexp_extract_all(lower(body), '{LETTERS}')) AS term FROM posts),
pscore AS (SELECT post_id, sum(weight) AS s FROM ptok JOIN lex USING (term) GROUP BY post_id),
ptop AS (SELECT DISTINCT post_id, topic FROM ptok JOIN tax USING (term)),
ptj AS (SELECT post_id, '[' || string_agg('"' || topic || '"', ',' ORDER BY topic) || ']' AS topics_json
        FROM ptop GROUP BY post_id),
plab AS (SELECT p.*, CASE WHEN coalesce(s, 0) > 0 THEN 'positive' WHEN coalesce(s, 0) < 0 THEN 'negative'
                     ELSE 'neutral' END AS sentiment, coalesce(topics_json, '[]') AS topics_json
         FROM posts p LEFT JOIN pscore USING (post_id) LEFT JOIN ptj USING (post_id)),
ent AS (SELECT 'r1' AS run_id, (row_number() OVER (ORDER BY post_id) - 1) // 10 AS chunk_id,
               CAST((row_number() OVER (ORDER BY post_id) - 1) % 10 + 1 AS INTEGER) AS entry_no,
               post_id, body, sentiment, topics_json FROM plab),
ent2 AS (SELECT *, count(*) OVER (PARTITION BY run_id, chunk_id) AS n_rows FROM ent)"""

NL = "\n"
_A8 = "',\"a,b\"]'"
REPLIES = POST_LABELS + f""",
cj AS (
  SELECT run_id, chunk_id, chunk_id % 10 AS d,
         count(*) FILTER (WHERE sentiment = 'positive') AS pos,
         count(*) FILTER (WHERE sentiment = 'neutral') AS neu,
         count(*) FILTER (WHERE sentiment = 'negative') AS neg,
         coalesce(string_agg('{{"entry":"' || entry_no || '","sentiment":"' ||
                  CASE WHEN chunk_id % 10 = 9 AND entry_no = 1 THEN 'mixed' ELSE sentiment END || '"}}', ','
                  ORDER BY entry_no) FILTER (WHERE NOT (chunk_id % 10 = 5 AND entry_no = n_rows)), '') AS sa,
         coalesce(string_agg('{{"entry":"' || entry_no || '","topics":' ||
                  CASE WHEN chunk_id % 10 = 8 AND entry_no = 1 THEN
                       CASE WHEN topics_json = '[]' THEN '["a,b"]'
                            ELSE substr(topics_json, 1, length(topics_json) - 1) || {_A8} END
                       ELSE topics_json END || '}}', ','
                  ORDER BY entry_no) FILTER (WHERE NOT (chunk_id % 10 = 5 AND entry_no = n_rows)), '') AS ta
  FROM ent2 GROUP BY run_id, chunk_id),
cjson AS (
  SELECT run_id, chunk_id, d,
         '{{"analyses":[' || sa || CASE WHEN d = 7 THEN CASE WHEN sa = '' THEN '' ELSE ',' END
              || '{{"entry":"extra","sentiment":"neutral"}}' ELSE '' END
           || '],"summary":{{"positive":' || (pos + CASE WHEN d = 9 THEN 1 ELSE 0 END)
           || ',"neutral":' || neu || ',"negative":' || neg || '}}}}' AS sj,
         '{{"analyses":[' || ta || CASE WHEN d = 7 THEN CASE WHEN ta = '' THEN '' ELSE ',' END
              || '{{"entry":"extra","topics":["t_extra"]}}' ELSE '' END || ']}}' AS tj
  FROM cj),
replies AS (
  SELECT run_id, chunk_id, kind,
         CASE WHEN d = 1 THEN {_q("Here is the analysis:" + NL + "```json" + NL)} || j
                              || {_q(NL + "```" + NL + "Let me know if you need more.")}
              WHEN d = 3 THEN '调用接口失败：timeout' ELSE j END AS reply
  FROM (SELECT run_id, chunk_id, d, 'sentiment' AS kind, sj AS j FROM cjson
        UNION ALL SELECT run_id, chunk_id, d, 'topic', tj FROM cjson)),
parsed0 AS (
  SELECT *, coalesce(nullif(regexp_extract(reply, {_q(FENCE_PATTERN)}, 1), ''), {trim_u('reply')}) AS clean
  FROM replies),
parsed AS (
  SELECT *, CASE WHEN starts_with(reply, '调用接口失败') THEN 'call_failed'
                 WHEN NOT coalesce(json_valid(clean), false) THEN 'bad_json' ELSE 'ok' END AS status
  FROM parsed0),
okr AS (SELECT run_id, chunk_id, kind, clean FROM parsed WHERE status = 'ok'),
aligned AS (
  SELECT e.run_id, e.chunk_id, e.entry_no, e.post_id, e.body, r.kind,
         CASE WHEN r.kind = 'sentiment'
              THEN coalesce((json_extract(r.clean, '$.analyses[*]'))[e.entry_no] ->> 'sentiment', '')
              ELSE coalesce(array_to_string(list_filter(list_transform(
                     json_extract_string((json_extract(r.clean, '$.analyses[*]'))[e.entry_no], '$.topics[*]'),
                     lambda x: {trim_u('x')}), lambda x: x <> ''), ', '), '') END AS label
  FROM ent e JOIN okr r ON r.run_id = e.run_id AND r.chunk_id = e.chunk_id),
tment AS (
  SELECT run_id, chunk_id, entry_idx, topic_pos, {trim_u('raw')} AS topic FROM (
    SELECT run_id, chunk_id, entry_idx, unnest(tl) AS raw, generate_subscripts(tl, 1) - 1 AS topic_pos FROM (
      SELECT run_id, chunk_id, entry_idx, coalesce(json_extract_string(a, '$.topics[*]'), []) AS tl FROM (
        SELECT run_id, chunk_id, unnest(al) AS a, generate_subscripts(al, 1) - 1 AS entry_idx FROM (
          SELECT run_id, chunk_id, json_extract(clean, '$.analyses[*]') AS al FROM okr WHERE kind = 'topic'))))
  WHERE {trim_u('raw')} <> ''),
registry AS (
  SELECT run_id, topic, chunk_id AS first_chunk, entry_idx AS first_entry, topic_pos AS first_pos FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, topic ORDER BY chunk_id, entry_idx, topic_pos) AS k
    FROM tment) WHERE k = 1)"""

ORACLE["chunks"] = f"WITH {POST_LABELS} SELECT run_id, chunk_id, entry_no, post_id FROM ent"

ORACLE["chunk_text"] = f"""
WITH {POST_LABELS}
SELECT run_id, chunk_id, string_agg(entry_no || ': ' || coalesce(body, ''), chr(10) ORDER BY entry_no) AS text
FROM ent GROUP BY run_id, chunk_id
"""

ORACLE["replies_parsed"] = f"""
WITH {REPLIES}
SELECT run_id, chunk_id, kind, status,
       CASE WHEN status = 'ok' THEN coalesce(json_array_length(clean, '$.analyses'), 0) ELSE 0 END AS n_analyses,
       CASE WHEN status = 'ok' THEN coalesce(CAST(json_extract(clean, '$.summary.positive') AS BIGINT), 0) ELSE 0 END
         AS sum_positive,
       CASE WHEN status = 'ok' THEN coalesce(CAST(json_extract(clean, '$.summary.neutral') AS BIGINT), 0) ELSE 0 END
         AS sum_neutral,
       CASE WHEN status = 'ok' THEN coalesce(CAST(json_extract(clean, '$.summary.negative') AS BIGINT), 0) ELSE 0 END
         AS sum_negative
FROM parsed
"""

ORACLE["reply_clean"] = f"WITH {REPLIES} SELECT run_id, chunk_id, kind, clean FROM parsed"
ORACLE["replies_status"] = f"WITH {REPLIES} SELECT run_id, chunk_id, kind, status FROM parsed"
ORACLE["labels_aligned"] = f"WITH {REPLIES} SELECT run_id, chunk_id, entry_no, post_id, kind, label FROM aligned"

ORACLE["sentiment_totals_reported"] = f"""
WITH {REPLIES}
SELECT CAST(sum(CAST(json_extract(clean, '$.summary.positive') AS BIGINT)) AS BIGINT) AS positive,
       CAST(sum(CAST(json_extract(clean, '$.summary.neutral') AS BIGINT)) AS BIGINT) AS neutral,
       CAST(sum(CAST(json_extract(clean, '$.summary.negative') AS BIGINT)) AS BIGINT) AS negative
FROM okr WHERE kind = 'sentiment'
"""

ORACLE["sentiment_totals_counted"] = f"""
WITH {REPLIES} SELECT label AS sentiment, count(*) AS n FROM aligned WHERE kind = 'sentiment' GROUP BY label
"""

ORACLE["sentiment_reconcile"] = f"""
WITH {REPLIES},
rep AS (SELECT run_id, chunk_id,
               coalesce(CAST(json_extract(clean, '$.summary.positive') AS BIGINT), 0) AS rp,
               coalesce(CAST(json_extract(clean, '$.summary.neutral') AS BIGINT), 0) AS ru,
               coalesce(CAST(json_extract(clean, '$.summary.negative') AS BIGINT), 0) AS rn
        FROM okr WHERE kind = 'sentiment'),
cnt AS (SELECT run_id, chunk_id, count(*) FILTER (WHERE label = 'positive') AS cp,
               count(*) FILTER (WHERE label = 'neutral') AS cu, count(*) FILTER (WHERE label = 'negative') AS cn
        FROM aligned WHERE kind = 'sentiment' GROUP BY run_id, chunk_id)
SELECT run_id, chunk_id, rp AS reported_positive, coalesce(cp, 0) AS counted_positive, rp - coalesce(cp, 0) AS diff_positive,
       ru AS reported_neutral, coalesce(cu, 0) AS counted_neutral, ru - coalesce(cu, 0) AS diff_neutral,
       rn AS reported_negative, coalesce(cn, 0) AS counted_negative, rn - coalesce(cn, 0) AS diff_negative
FROM rep LEFT JOIN cnt USING (run_id, chunk_id)
"""

ORACLE["topic_counts"] = f"WITH {REPLIES} SELECT run_id, topic, count(*) AS n FROM tment GROUP BY run_id, topic"
ORACLE["topic_registry"] = f"WITH {REPLIES} SELECT * FROM registry"

ORACLE["topics_visible"] = f"""
WITH {REPLIES},
ch AS (SELECT DISTINCT run_id, chunk_id FROM ent)
SELECT c.run_id, c.chunk_id,
       coalesce(string_agg(r.topic, ', ' ORDER BY r.first_chunk, r.first_entry, r.first_pos), '无') AS topics_visible
FROM ch c LEFT JOIN registry r ON r.run_id = c.run_id AND r.first_chunk < c.chunk_id
GROUP BY c.run_id, c.chunk_id
"""

_CHUNK_TEXT = ("ctext AS (SELECT run_id, chunk_id, string_agg(entry_no || ': ' || coalesce(body, ''), chr(10) "
               "ORDER BY entry_no) AS text FROM ent GROUP BY run_id, chunk_id)")
_VISIBLE = ("vis AS (SELECT c.run_id, c.chunk_id, coalesce(string_agg(r.topic, ', ' ORDER BY r.first_chunk, "
            "r.first_entry, r.first_pos), '无') AS topics_visible FROM (SELECT DISTINCT run_id, chunk_id FROM ent) c "
            "LEFT JOIN registry r ON r.run_id = c.run_id AND r.first_chunk < c.chunk_id GROUP BY c.run_id, c.chunk_id)")
_PROMPT = ("prompts AS (SELECT run_id, chunk_id, "
           + _q("请基于以下公民意见数据和当前主题列表进行主题分析：" + NL + NL + "公民意见：" + NL)
           + " || text || " + _q(NL + NL + "当前主题列表：") + " || topics_visible || " + _q(NL + NL)
           + " AS prompt FROM ctext JOIN vis USING (run_id, chunk_id))")

ORACLE["chunk_prompts"] = f"WITH {REPLIES}, {_CHUNK_TEXT}, {_VISIBLE}, {_PROMPT} SELECT * FROM prompts"

ORACLE["topics_new"] = f"""
WITH {REPLIES}
SELECT * FROM registry WHERE topic NOT IN (SELECT topic FROM tax)
"""

ORACLE["chunk_mismatch"] = f"""
WITH {REPLIES},
nr AS (SELECT run_id, chunk_id, count(*) AS n_rows FROM ent GROUP BY run_id, chunk_id)
SELECT kind, count(*) FILTER (WHERE json_array_length(clean, '$.analyses') <> n_rows) AS mismatched,
       count(*) AS checked
FROM okr JOIN nr USING (run_id, chunk_id) GROUP BY kind
"""

ORACLE["labels_known"] = f"""
WITH {REPLIES}
SELECT run_id, chunk_id, entry_no, post_id, label AS sentiment FROM aligned
WHERE kind = 'sentiment' AND label IN ('negative', 'neutral', 'positive')
"""

_FILES = """
tfile AS (SELECT entry_no, body, label AS topics FROM aligned WHERE kind = 'topic'),
sfile AS (SELECT entry_no, body, label AS sentiment FROM aligned WHERE kind = 'sentiment'),
sagg AS (SELECT entry_no, body, sentiment, count(*) AS n FROM sfile GROUP BY ALL),
merged AS (SELECT t.entry_no, t.body, t.topics, s.sentiment, coalesce(s.n, 1) AS n
           FROM tfile t LEFT JOIN sagg s ON t.entry_no IS NOT DISTINCT FROM s.entry_no
                                          AND t.body IS NOT DISTINCT FROM s.body)"""

ORACLE["merged_labels"] = f"WITH {REPLIES}, {_FILES} SELECT * FROM merged"

ORACLE["merged_labels_strict"] = f"""
WITH {REPLIES}
SELECT t.run_id, t.chunk_id, t.entry_no, t.post_id, t.label AS topics, s.label AS sentiment
FROM (SELECT * FROM aligned WHERE kind = 'topic') t
LEFT JOIN (SELECT * FROM aligned WHERE kind = 'sentiment') s USING (run_id, chunk_id, entry_no)
"""

_CLEAN = f"mclean AS (SELECT topics, sentiment, n FROM merged WHERE topics IS NOT NULL AND {trim_u('topics')} <> '')"
_MENTIONS = (f"ment AS (SELECT topic, {trim_u('sentiment')} AS sentiment, n FROM ("
             f"SELECT {trim_u('unnest(string_split(topics, chr(44)))')} AS topic, sentiment, n FROM mclean) "
             f"WHERE topic <> '')")

ORACLE["merged_clean"] = f"WITH {REPLIES}, {_FILES}, {_CLEAN} SELECT * FROM mclean"
ORACLE["topic_mentions"] = f"WITH {REPLIES}, {_FILES}, {_CLEAN}, {_MENTIONS} SELECT * FROM ment"
ORACLE["merged_topic_sentiment"] = f"""
WITH {REPLIES}, {_FILES}, {_CLEAN}, {_MENTIONS}
SELECT topic,
       CAST(sum(CASE WHEN sentiment = 'negative' THEN n ELSE 0 END) AS BIGINT) AS negative,
       CAST(sum(CASE WHEN sentiment = 'neutral' THEN n ELSE 0 END) AS BIGINT) AS neutral,
       CAST(sum(CASE WHEN sentiment = 'positive' THEN n ELSE 0 END) AS BIGINT) AS positive,
       CAST(sum(CASE WHEN sentiment IN ('negative', 'neutral', 'positive') THEN n ELSE 0 END) AS BIGINT) AS total
FROM ment GROUP BY topic
"""

ORACLE["chunk_messages"] = f"""
WITH {REPLIES}, {_CHUNK_TEXT}, {_VISIBLE}, {_PROMPT},
sys(kind, system) AS (VALUES
  ('sentiment', 'Label each numbered entry as positive, neutral or negative; reply with JSON analyses and summary.'),
  ('topic', 'Name the public-impact topics of each numbered entry; reply with JSON analyses.')),
u AS (SELECT run_id, chunk_id, 'sentiment' AS kind, text AS "user" FROM ctext
      UNION ALL SELECT run_id, chunk_id, 'topic', prompt FROM prompts)
SELECT run_id, chunk_id, kind, CAST(2 AS BIGINT) AS n_messages, system, "user" FROM u JOIN sys USING (kind)
"""

ORACLE["labels_via_hook"] = f"WITH {POST_LABELS} SELECT run_id, chunk_id, entry_no, post_id, sentiment FROM ent"


# ------------------------------------------------------------------ feed and times

def feed_ts(s: str, ref: str) -> str:
    """F1 in DuckDB: the eight rules, first match wins; invalid dates give NULL."""
    def g(rule, i):
        return f"TRY_CAST(regexp_extract({s}, {_q(rule)}, {i}) AS INTEGER)"

    def gt(rule, i):
        return f"TRY_CAST(trim(regexp_extract({s}, {_q(rule)}, {i})) AS INTEGER)"

    def mk(y, m, d, h, mi):
        return f"TRY(make_timestamp({y}, {m}, {d}, {h}, {mi}, 0.0))"

    r1, r2, r4, r5, r6, r7, r8 = RULE_YMD_HM, RULE_MD_HM, RULE_ISO_HM, RULE_ISO_DAY, RULE_TODAY_HM, \
        RULE_MINUTES_AGO, RULE_HOURS_AGO
    return f"""(CASE
      WHEN regexp_matches({s}, {_q(r1)}) THEN {mk(g(r1, 1), g(r1, 2), g(r1, 3), g(r1, 4), g(r1, 5))}
      WHEN regexp_matches({s}, {_q(r2)}) THEN {mk(f'year({ref})', g(r2, 1), g(r2, 2), g(r2, 3), g(r2, 4))}
      WHEN contains({s}, '刚刚') THEN {ref}
      WHEN regexp_matches({s}, {_q(r4)}) THEN {mk(g(r4, 1), g(r4, 2), gt(r4, 3), g(r4, 4), g(r4, 5))}
      WHEN regexp_matches({s}, {_q(r5)}) THEN {mk(g(r5, 1), g(r5, 2), gt(r5, 3), 0, 0)}
      WHEN contains({s}, '今天') THEN CASE WHEN regexp_matches({s}, {_q(r6)})
           THEN {mk(f'year({ref})', f'month({ref})', f'day({ref})', g(r6, 1), g(r6, 2))} ELSE {ref} END
      WHEN regexp_matches({s}, {_q(r7)}) THEN {ref} - to_minutes({g(r7, 1)})
      WHEN regexp_matches({s}, {_q(r8)}) THEN {ref} - to_hours({g(r8, 1)})
    END)"""


REF = "TIMESTAMP '2024-01-31 00:00:00'"
TSF = "'%Y-%m-%d %H:%M:%S'"
ITEM_OPEN_SQL = _q('<div class="card-wrap" action-type="feed_list_item">')


def _esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _kind(a: str, b: str, c: str) -> str:
    return f"CASE post_id % 3 WHEN 0 THEN {_q(a)} WHEN 1 THEN {_q(b)} ELSE {_q(c)} END"


def _page_text(x: str) -> str:
    return (f"CASE post_id % 3 WHEN 1 THEN replace(replace({_esc(x)}, chr(39), '&#39;'), 'é', '&#233;') "
            f"WHEN 2 THEN '&nbsp;' || replace({_esc(x)}, 'ü', '&#xFC;') || '<br/>' ELSE {_esc(x)} END")


def _unless(k: int, html: str) -> str:
    return f"CASE WHEN post_id % 50 = {k} THEN '' ELSE {html} END"


_FULL = (_kind('<p node-type="feed_list_content_full">', '<p style="display: none" node-type="feed_list_content_full">',
               '<p node-type="feed_list_content_full" class="txt">') + f" || {_page_text('body')} || '</p>' || chr(10)")
_SHORT = "CASE WHEN post_id % 2 = 0 THEN substr(body, 1, 60) ELSE body END"
_LI = _kind("<li>", '<li class="n"><div><a href="#">', "<li><span>")
_LI_END = _kind("</li>", "</a></div></li>", "</span></li>")
_CONTENT = (_kind('<p node-type="feed_list_content" nick-name="', '<p class="txt" nick-name="',
                  '<p class="txt hot" data-k="1" node-type="feed_list_content" nick-name="')
            + f" || {_esc('author')} || " + _kind('">', '" node-type="feed_list_content">', '">')
            + f" || ({_page_text('(' + _SHORT + ')')}) || '</p>' || chr(10) || CASE WHEN post_id % 2 = 0 THEN {_FULL} ELSE '' END")
_FROM = (_kind('<div class="from">', '<div class="from s">', '<div data-k="1" class="card from">') + " || "
         + _kind("", "", '<a href="#">') + " || posted_raw || " + _kind("", "", "</a> ")
         + " || CASE WHEN via IS NULL THEN '' ELSE '来自' || " + _kind("", "", '<a rel="nofollow">') + " || via || "
         + _kind("", "", "</a>") + " END || '</div>' || chr(10)")
_ACTS = (_kind('<div class="card-act">', '<div class="card-act s">', '<div id="x" class="card-act">') + " || '<ul>' || "
         + " || ".join(f"{_LI} || {c} || {_LI_END}" for c in ("reposts_raw", "comments_raw", "likes_raw")) + " || '</ul></div>'")

FEED = POSTS + f""",
items AS (
  SELECT post_id, {ITEM_OPEN_SQL} || '<a nick-name="someone else" href="#">x</a>' || {_unless(30, _CONTENT)}
         || {_unless(10, _FROM)} || {_unless(20, _ACTS)} || '</div>' AS item
  FROM posts),
fpages AS (
  SELECT post_id // 10 AS page_id,
         '<html><body><div id="pl_feedlist_index">' || string_agg(item, '' ORDER BY post_id) || '</div></body></html>'
         AS html
  FROM items GROUP BY 1),
shown AS (
  SELECT post_id, body, author, CASE WHEN post_id % 50 = 10 THEN '' ELSE posted_raw END AS posted_raw,
         CASE WHEN post_id % 50 <> 10 THEN via END AS via, CASE WHEN post_id % 50 <> 20 THEN reposts_raw END AS reposts_raw,
         CASE WHEN post_id % 50 <> 20 THEN comments_raw END AS comments_raw,
         CASE WHEN post_id % 50 <> 20 THEN likes_raw END AS likes_raw
  FROM posts),
fposts AS (
  SELECT post_id // 10 AS page_id,
         CAST(row_number() OVER (PARTITION BY post_id // 10 ORDER BY post_id) AS INTEGER) AS item_no,
         CAST((post_id // 10) % 49 + 1 AS INTEGER) AS page_no, 'the' AS keyword,
         '2024-01-01 06:00:00' AS win_start, '2024-01-02 00:00:00' AS win_end,
         CASE WHEN post_id % 50 <> 30 THEN author END AS author,
         {trim_u('posted_raw')} AS posted_raw, coalesce(via, '无') AS via, reposts_raw, comments_raw, likes_raw,
         CASE WHEN post_id % 50 = 30 THEN '' ELSE {trim_u('body')} END AS body,
         {feed_ts('posted_raw', REF)} AS posted_ts
  FROM shown)"""

ORACLE["feed_items"] = f"""
WITH {FEED}
SELECT page_id, CAST(generate_subscripts(parts, 1) AS INTEGER) AS item_no, {ITEM_OPEN_SQL} || unnest(parts) AS item
FROM (SELECT page_id, (string_split(html, {ITEM_OPEN_SQL}))[2:] AS parts FROM fpages)
"""

_FP_COLS = ("page_id, item_no, page_no, keyword, win_start, win_end, author, posted_raw, via, reposts_raw, "
            f"comments_raw, likes_raw, body, strftime(posted_ts, {TSF}) AS posted_at")
ORACLE["feed_posts"] = f"WITH {FEED} SELECT {_FP_COLS} FROM fposts"
ORACLE["posts_in_range"] = f"""WITH {FEED} SELECT {_FP_COLS} FROM fposts
WHERE posted_ts BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-02 00:00:00'"""
ORACLE["posts_with_keyword"] = f"WITH {FEED} SELECT {_FP_COLS} FROM fposts WHERE contains(body, keyword)"

ORACLE["feed_time"] = f"""
WITH {POSTS} SELECT post_id, posted_raw, strftime({feed_ts('posted_raw', REF)}, {TSF}) AS posted_at FROM posts
"""

_DAYS = "days AS (SELECT DISTINCT CAST(posted_at AS DATE) AS day FROM posts)"
ORACLE["hour_windows"] = f"""
WITH {POSTS}, {_DAYS}
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(h AS INTEGER) AS hour,
       strftime(day + to_hours(h), '%Y-%m-%d-%H') AS win_start,
       strftime(day + to_hours(h + 1), '%Y-%m-%d-%H') AS win_end,
       strftime(strptime(strftime(day + to_hours(h), '%Y-%m-%d-%H'), '%Y-%m-%d-%H'), {TSF}) AS start_parsed
FROM days, range(24) t(h)
"""

_WINS = "wins AS (SELECT day + to_hours(h) AS ws FROM days, range(24) t(h))"
ORACLE["posts_by_hour_closed"] = f"""
WITH {POSTS}, {_DAYS}, {_WINS}
SELECT p.post_id, strftime(w.ws, {TSF}) AS win_start
FROM posts p JOIN wins w ON p.posted_at BETWEEN w.ws AND w.ws + INTERVAL 1 HOUR
"""

ORACLE["posts_dedup"] = f"""
WITH {POSTS}, {_DAYS}, {_WINS},
h AS (SELECT p.* FROM posts p JOIN wins w ON p.posted_at BETWEEN w.ws AND w.ws + INTERVAL 1 HOUR)
SELECT author, strftime(posted_at, {TSF}) AS posted_at, body, count(*) AS n_copies, min(post_id) AS post_id
FROM h GROUP BY author, posted_at, body
"""

ORACLE["posts_union"] = f"""
WITH {FEED}
SELECT 'feed' AS src, page_id, item_no, author, posted_raw, via, body FROM fposts
UNION ALL BY NAME
SELECT 'table' AS src, post_id, author, posted_raw, via, body FROM posts
"""

_MON = "CAST(month(day) AS VARCHAR)"


def _req_json(platform: str, month: str, with_day: bool = True, kws: str = "kws") -> str:
    s = (f"""'{{"event_keywords":' || {kws} || ',"start_year":"' || CAST(year(day) AS VARCHAR) || """
         f"""'","start_month":"' || {month}""")
    if with_day:
        s += """ || '","start_day":"' || CAST(day(day) AS VARCHAR)"""
    s += f""" || '","event_release_platform":"{platform}"}}'"""
    return s


REQUESTS = POSTS + f""",
rqf AS (SELECT CAST(posted_at AS DATE) AS day, author, min(posted_at) AS requested_at, min(post_id) AS first_post
        FROM posts WHERE posted_at IS NOT NULL GROUP BY ALL),
rq AS (SELECT CAST('0x' || substr(md5(strftime(rqf.day, '%Y-%m-%d') || '|' || coalesce(rqf.author, '')), 1, 15) AS BIGINT)
                AS request_id, rqf.day, rqf.requested_at, regexp_extract_all(lower(p.body), '{LETTERS}')[1] AS kw
       FROM rqf JOIN posts p ON p.post_id = rqf.first_post),
rq1 AS (SELECT *, CASE WHEN kw IS NULL THEN '[]' ELSE '["#' || kw || '#"]' END AS kws FROM rq),
reqs AS (
  SELECT request_id, requested_at, day,
         CASE request_id % 7
           WHEN 0 THEN {_req_json('Weibo', _MON)}
           WHEN 1 THEN '```json' || chr(10) || {_req_json('微博', _MON)} || chr(10) || '```'
           WHEN 2 THEN {_req_json('other', _MON)}
           WHEN 3 THEN {_req_json('Weibo', _MON, with_day=False)}
           WHEN 4 THEN {_req_json('Weibo', "'Jan'")}
           WHEN 5 THEN 'Which day do you mean?'
           ELSE {_req_json('Weibo', _MON, kws="'[]'")} END AS reply,
         CASE request_id % 4
           WHEN 0 THEN '请分析#' || coalesce(kw, '') || '# ' || strftime(day, '%Y-%m-%d') || ' 微博'
           WHEN 1 THEN '#' || coalesce(kw, '') || '# ' || CAST(year(day) AS VARCHAR) || '年' || {_MON} || '月'
                       || CAST(day(day) AS VARCHAR) || '日 Weibo'
           WHEN 2 THEN '#' || coalesce(kw, '') || '# Weibo'
           ELSE strftime(day, '%Y-%m-%d') END AS text
  FROM rq1),
rc AS (SELECT *, coalesce(nullif(regexp_extract(reply, {_q(FENCE_PATTERN)}, 1), ''), {trim_u('reply')}) AS clean
       FROM reqs),
rv AS (
  SELECT *, CASE
      WHEN NOT coalesce(json_valid(clean), false) THEN 'not_json'
      WHEN NOT list_has_all(json_keys(clean), ['event_keywords', 'start_year', 'start_month', 'start_day',
                                               'event_release_platform']) THEN 'incomplete'
      WHEN coalesce(lower(json_extract_string(clean, '$.event_release_platform')) NOT IN ('weibo', '微博'), true)
        THEN 'unsupported_platform'
      WHEN TRY_CAST(json_extract_string(clean, '$.start_year') AS INTEGER) IS NULL
        OR TRY_CAST(json_extract_string(clean, '$.start_month') AS INTEGER) IS NULL
        OR TRY_CAST(json_extract_string(clean, '$.start_day') AS INTEGER) IS NULL THEN 'bad_date'
      WHEN coalesce(json_array_length(clean, '$.event_keywords'), 0) < 1 THEN 'no_keyword'
      ELSE 'ok' END AS status
  FROM rc),
rok AS (
  SELECT request_id, trim(json_extract_string(clean, '$.event_keywords[0]'), '#') AS keyword,
         json_extract_string(clean, '$.event_keywords[0]') AS event_keyword, CAST(request_id % 2 + 1 AS INTEGER) AS days,
         CAST(TRY(make_date(TRY_CAST(json_extract_string(clean, '$.start_year') AS INTEGER),
                            TRY_CAST(json_extract_string(clean, '$.start_month') AS INTEGER),
                            TRY_CAST(json_extract_string(clean, '$.start_day') AS INTEGER))) AS DATE) AS start_date
  FROM rv WHERE status = 'ok')"""

ORACLE["requests_validated"] = f"""
WITH {REQUESTS}
SELECT rv.request_id, rv.status, rok.keyword, strftime(rok.start_date, '%Y-%m-%d') AS start_date
FROM rv LEFT JOIN rok USING (request_id)
"""

ORACLE["run_stamp"] = f"""
WITH {REQUESTS}
SELECT request_id, '微博数据_' || strftime(requested_at, '%Y%m%d%H%M%S') || '.csv' AS file_name FROM reqs
"""

ORACLE["posts_for_requests"] = f"""
WITH {REQUESTS}
SELECT r.request_id, p.post_id FROM rok r JOIN posts p
  ON p.posted_at BETWEEN r.start_date AND r.start_date + to_days(r.days) AND contains(p.body, r.keyword)
"""

_ISO = r"(\d{4})-(\d{1,2})-(\d{1,2})"
_CJK = r"(\d{4})年(\d{1,2})月(\d{1,2})日"


def _datepart(i: int) -> str:
    return (f"CAST(TRY_CAST(CASE WHEN regexp_matches(text, {_q(_ISO)}) THEN regexp_extract(text, {_q(_ISO)}, {i}) "
            f"WHEN regexp_matches(text, {_q(_CJK)}) THEN regexp_extract(text, {_q(_CJK)}, {i}) END AS INTEGER) "
            f"AS VARCHAR)")


ORACLE["request_fields"] = f"""
WITH {REQUESTS},
f AS (SELECT request_id,
             CASE WHEN len(regexp_extract_all(text, '#([^#]+)#', 1)) > 0 THEN
               array_to_string(list_transform(regexp_extract_all(text, '#([^#]+)#', 1), lambda x: '#' || x || '#'), ',')
             END AS event_keywords,
             {_datepart(1)} AS start_year, {_datepart(2)} AS start_month, {_datepart(3)} AS start_day,
             nullif(regexp_extract(text, '(?i)(weibo|微博)', 1), '') AS event_release_platform
      FROM reqs)
SELECT *, array_to_string(list_filter([
    CASE WHEN event_keywords IS NULL THEN 'event_keywords' END, CASE WHEN start_year IS NULL THEN 'start_year' END,
    CASE WHEN start_month IS NULL THEN 'start_month' END, CASE WHEN start_day IS NULL THEN 'start_day' END,
    CASE WHEN event_release_platform IS NULL THEN 'event_release_platform' END], lambda x: x IS NOT NULL), ',')
  AS missing
FROM f
"""

ORACLE["src_raw_pages"] = """
SELECT page_id, url, regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1) AS host, CAST(length(html) AS BIGINT) AS n_chars
FROM pages
"""

_NODE = ("trim(replace(replace(replace(replace(replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '&lt;', '<'), "
         "'&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), " + WS + ")")

ORACLE["page_paragraphs"] = f"""
SELECT page_id,
       {_NODE.format(x="regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")} AS title,
       CAST(len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '', 'g'),
            '(?s)<style[^>]*>.*?</style>', '', 'g'), '<p[ >]')) AS BIGINT) AS n_paragraphs
FROM pages
"""

ORACLE["hashtags"] = """
SELECT doc_id, CAST(generate_subscripts(tags, 1) AS INTEGER) AS tag_no, unnest(tags) AS tag
FROM (SELECT doc_id, regexp_extract_all(text, '#([^#]+)#', 1) AS tags FROM documents)
"""

ORACLE["body_no_hashtags"] = f"""
SELECT doc_id, {trim_u("regexp_replace(text, '#[^#]+#', '', 'g')")} AS text FROM documents
"""

ORACLE["utrim_check"] = f"""
SELECT conv_id, turn, {trim_u('text')} AS text, CAST(length(text) - length({trim_u('text')}) AS BIGINT) AS n_trimmed
FROM conversations
"""


# ----------------------------------------------------------------------- analytics

ORACLE["term_frequency"] = f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{LETTERS}')) AS term FROM documents)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t GROUP BY term
"""

ORACLE["keyword_clusters"] = f"""
WITH RECURSIVE toks AS MATERIALIZED (SELECT regexp_extract_all(lower(text), '{LETTERS}') AS l FROM documents WHERE text IS NOT NULL),
every AS (SELECT term, count(*) AS n FROM (SELECT unnest(l) AS term FROM toks) GROUP BY term),
kw AS MATERIALIZED (SELECT * FROM every WHERE n >= 3),
near AS (SELECT unnest(list_zip(l[1:len(l) - 1], l[2:len(l)])) AS p FROM toks WHERE len(l) > 1),
pairs AS (SELECT least(p[1], p[2]) AS a, greatest(p[1], p[2]) AS b, count(*) AS n FROM near WHERE p[1] <> p[2] GROUP BY ALL HAVING count(*) >= 3),
links AS MATERIALIZED (SELECT a, b, p.n, (p.n * (SELECT sum(n) FROM every))::DOUBLE / (x.n * y.n)::DOUBLE AS lift
          FROM pairs p JOIN kw x ON x.term = a JOIN kw y ON y.term = b),
sides AS (SELECT a AS term, b AS neighbour, * FROM links WHERE lift > 1 UNION ALL SELECT b, a, * FROM links WHERE lift > 1),
best AS MATERIALIZED (SELECT term, neighbour, lift FROM sides
                      QUALIFY row_number() OVER (PARTITION BY term ORDER BY lift DESC, n DESC, a, b) = 1),
parent AS MATERIALIZED (SELECT t.term, CASE WHEN u.neighbour = t.term THEN least(t.term, u.term) ELSE u.term END AS up
                        FROM best t JOIN best u ON u.term = t.neighbour),
walk AS (SELECT term, up AS at FROM parent UNION SELECT w.term, p.up FROM walk w JOIN parent p ON p.term = w.at),
ends AS (SELECT w.term, w.at AS cluster FROM walk w JOIN parent p ON p.term = w.at AND p.up = w.at),
placed AS (SELECT k.term, k.n, coalesce(e.cluster, k.term) AS cluster, b.neighbour, round(ln(b.lift), 6) AS weight
           FROM kw k LEFT JOIN best b USING (term) LEFT JOIN ends e USING (term))
SELECT term, n, cluster, count(*) OVER (PARTITION BY cluster) AS size, neighbour, weight FROM placed
"""

ORACLE["negative_spikes"] = f"""
WITH {POST_LABELS},
pm AS (SELECT t.topic, date_trunc('hour', p.posted_at) AS hour, p.sentiment FROM ptop t JOIN plab p USING (post_id)),
hourly AS (SELECT topic, hour, count(*) FILTER (WHERE sentiment = 'negative') AS neg FROM pm GROUP BY topic, hour),
span AS (SELECT topic, min(hour) AS lo, max(hour) AS hi FROM hourly GROUP BY topic),
grid AS (SELECT topic, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM span),
dense AS (SELECT g.topic, g.hour, coalesce(h.neg, 0) AS neg FROM grid g LEFT JOIN hourly h USING (topic, hour)),
st AS (SELECT *, avg(neg) OVER w AS mean, stddev_samp(neg) OVER w AS sd FROM dense
       WINDOW w AS (PARTITION BY topic ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
SELECT topic, strftime(hour, {TSF}) AS hour, neg, round(mean, 6) AS mean, round(sd, 6) AS sd
FROM st WHERE neg > mean + 3 * sd
"""

ORACLE["conversation_prefix"] = f"""
SELECT conv_id, row_number() OVER w AS message_no, role, text,
       CASE WHEN role = 'user' THEN CAST(count(*) FILTER (WHERE role = 'user') OVER w AS BIGINT) END AS call_no
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, sha256(text) NULLS FIRST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
UNION ALL
SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 'system', {_q(SYSTEM_MESSAGE)}, CAST(NULL AS BIGINT) FROM conversations
"""
