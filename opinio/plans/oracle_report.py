"""DuckDB oracles of the per-event report queries."""

from __future__ import annotations

from opinio.plans.oracle import ORACLE, POST_LABELS, POSTS, REQUESTS

Q = "''''"  # a SQL literal holding one single quote


def _pct(n: str, total: str) -> str:
    x = f"(CASE WHEN {total} > 0 THEN (2000 * {n} + {total}) // (2 * {total}) ELSE 0 END)"
    return f"(CAST({x} // 10 AS VARCHAR) || '.' || CAST({x} % 10 AS VARCHAR))"


REPORT = POST_LABELS + REQUESTS[len(POSTS):] + f""",
evp AS (SELECT r.request_id, p.post_id, p.sentiment FROM rok r JOIN plab p
          ON p.posted_at BETWEEN r.start_date AND r.start_date + to_days(r.days) AND contains(p.body, r.keyword)),
ptpos AS (SELECT post_id, topic, row_number() OVER (PARTITION BY post_id ORDER BY topic) - 1 AS pos FROM ptop),
evt AS (SELECT e.request_id, e.post_id, e.sentiment, t.topic, t.pos FROM evp e JOIN ptpos t USING (post_id)),
tm AS (SELECT request_id, topic, count(*) AS n,
              count(*) FILTER (WHERE sentiment = 'negative') AS neg,
              count(*) FILTER (WHERE sentiment = 'neutral') AS neu,
              count(*) FILTER (WHERE sentiment = 'positive') AS pos,
              arg_min(pos, post_id * 1000 + pos) AS first_pos, min(post_id) AS first_post
       FROM evt GROUP BY request_id, topic),
cnt AS (SELECT r.request_id, r.event_keyword,
               count(e.post_id) FILTER (WHERE e.sentiment = 'positive') AS positive,
               count(e.post_id) FILTER (WHERE e.sentiment = 'neutral') AS neutral,
               count(e.post_id) FILTER (WHERE e.sentiment = 'negative') AS negative
        FROM rok r LEFT JOIN evp e USING (request_id) GROUP BY r.request_id, r.event_keyword),
cnt2 AS (SELECT *, positive + neutral + negative AS total FROM cnt),
srt AS (SELECT request_id, 'Of ' || total || ' posts, '
          || positive || ' positive posts (' || {_pct("positive", "total")} || '%), '
          || neutral || ' neutral posts (' || {_pct("neutral", "total")} || '%) and '
          || negative || ' negative posts (' || {_pct("negative", "total")} || '%).' AS text FROM cnt2),
trt0 AS (SELECT t.request_id, string_agg({Q} || t.topic || {Q} || ' accounts for ' || t.n || ' posts, '
                || {_pct("t.n", "c.total")} || '% of the total', '; ' ORDER BY t.n DESC, t.topic) AS text
         FROM tm t JOIN cnt2 c USING (request_id) GROUP BY t.request_id),
trt AS (SELECT c.request_id, coalesce(t.text, '无') AS text FROM cnt2 c LEFT JOIN trt0 t USING (request_id)),
tab0 AS (SELECT request_id, 'topics negative neutral positive total' || chr(10)
                || string_agg(topic || ' ' || neg || ' ' || neu || ' ' || pos || ' ' || (neg + neu + pos), chr(10)
                              ORDER BY (neg + neu + pos) DESC, topic) AS text
         FROM tm GROUP BY request_id),
tab AS (SELECT c.request_id, coalesce(t.text, '无') AS text FROM cnt2 c LEFT JOIN tab0 t USING (request_id))"""

ORACLE["sentiment_report_input"] = f"""
WITH {REPORT}
SELECT request_id, '请帮我对 ' || event_keyword || ' 事件进行总结，它的累计情感统计:' || chr(10)
       || 'Positive: ' || positive || chr(10) || 'Neutral: ' || neutral || chr(10) || 'Negative: ' || negative AS text
FROM cnt2
"""

ORACLE["topic_report_input"] = f"""
WITH {REPORT},
lines AS (SELECT request_id, string_agg(topic || ': ' || n || chr(10), '' ORDER BY first_post, first_pos) AS l
          FROM tm GROUP BY request_id)
SELECT r.request_id, '请帮我对 ' || r.event_keyword || ' 事件进行总结，以下是各主题的讨论量统计：' || chr(10)
       || coalesce(l.l, '') AS text
FROM rok r LEFT JOIN lines l USING (request_id)
"""

ORACLE["sentiment_report_text"] = f"WITH {REPORT} SELECT * FROM srt"
ORACLE["topic_report_text"] = f"WITH {REPORT} SELECT * FROM trt"
ORACLE["table_as_text"] = f"WITH {REPORT} SELECT * FROM tab"

ORACLE["event_report_input"] = f"""
WITH {REPORT}
SELECT r.request_id, '请帮我对 ' || r.event_keyword || ' 事件进行总结，综合以下三部分信息：' || chr(10) || chr(10)
       || '【情感分析总结】:' || chr(10) || coalesce(s.text, '无') || chr(10) || chr(10)
       || '【主题分析总结】:' || chr(10) || coalesce(t.text, '无') || chr(10) || chr(10)
       || '【合并统计信息】:' || chr(10) || coalesce(m.text, '无') || chr(10) || chr(10) || '请生成最终的事件总结。' AS text
FROM rok r LEFT JOIN srt s USING (request_id) LEFT JOIN trt t USING (request_id) LEFT JOIN tab m USING (request_id)
"""

ORACLE["event_report_sections"] = f"""
WITH {REPORT}
SELECT r.request_id, '请帮我对 ' || r.event_keyword || ' 事件进行总结，综合以下三部分信息：' || chr(10) || chr(10)
       || '【情感分析总结】:' || chr(10) || CASE WHEN r.request_id % 4 = 1 THEN '无' ELSE s.text END || chr(10) || chr(10)
       || '【主题分析总结】:' || chr(10) || CASE WHEN r.request_id % 4 = 2 THEN '无' ELSE t.text END || chr(10) || chr(10)
       || '【合并统计信息】:' || chr(10) || CASE WHEN r.request_id % 4 = 3 THEN '无' ELSE m.text END || chr(10) || chr(10)
       || '请生成最终的事件总结。' AS text
FROM rok r JOIN srt s USING (request_id) JOIN trt t USING (request_id) JOIN tab m USING (request_id)
"""


# ------------------------------------------------------------------ sources, sinks

from opinio.plans.oracle import _CLEAN, _FILES, _MENTIONS, FEED, REPLIES  # noqa: E402

# a CSV field holding the empty string reads back as missing, like the source program's reader

ORACLE["src_posts_csv"] = f"""
WITH {POSTS}
SELECT page_no, nullif(author, '') AS author, nullif(posted_raw, '') AS posted_raw, coalesce(via, '无') AS via,
       reposts_raw, comments_raw, likes_raw, nullif(body, '') AS body FROM posts
"""

ORACLE["src_label_csv"] = f"""
WITH {REPLIES}
SELECT kind, entry_no, nullif(body, '') AS body, nullif(label, '') AS label FROM aligned
"""

ORACLE["sink_append_labels"] = f"""
WITH {REPLIES}
SELECT run_id, CAST(chunk_id % 3 AS VARCHAR) AS part_id, kind, entry_no, nullif(body, '') AS body,
       nullif(label, '') AS label FROM aligned
"""

_WANTED = """wanted AS (SELECT DISTINCT name FROM (
    SELECT 'item_' || CAST(item_id AS VARCHAR) AS name FROM benchmark
    UNION ALL SELECT 'lang_' || lang FROM documents)),
files AS (SELECT 'item_' || CAST(item_id AS VARCHAR) AS name, text AS body FROM benchmark)"""

ORACLE["templates_with_default"] = f"""
WITH {_WANTED}
SELECT w.name, coalesce(f.body, '默认系统提示信息') AS body, f.body IS NULL AS is_default
FROM wanted w LEFT JOIN files f USING (name)
"""

ORACLE["image_parts"] = f"""
WITH {_WANTED}
SELECT w.name, 'describe ' || w.name AS text, CAST(CASE WHEN f.body IS NULL THEN 1 ELSE 2 END AS BIGINT) AS n_parts,
       'data:image/jpeg;base64,' || to_base64(encode(f.body)) AS image_url
FROM wanted w LEFT JOIN files f USING (name)
"""

ORACLE["sink_append_posts"] = f"""
WITH {FEED}
SELECT page_no, nullif(author, '') AS author, nullif(posted_raw, '') AS posted_raw, coalesce(via, '无') AS via,
       reposts_raw, comments_raw, likes_raw, nullif(body, '') AS body, 'table' AS run_id,
       coalesce(CAST(hour(posted_at) // 8 AS VARCHAR), 'none') AS part_id FROM posts
UNION ALL
SELECT page_no, nullif(author, '') AS author, nullif(posted_raw, '') AS posted_raw, nullif(via, '') AS via,
       reposts_raw, comments_raw, likes_raw, nullif(body, '') AS body, 'feed' AS run_id,
       CAST(page_id % 2 AS VARCHAR) AS part_id FROM fposts
"""

ORACLE["sink_overwrite_merged"] = f"""
WITH {REPLIES}, {_FILES}, {_CLEAN}, {_MENTIONS}
SELECT topic AS topics,
       CAST(sum(CASE WHEN sentiment = 'negative' THEN n ELSE 0 END) AS BIGINT) AS negative,
       CAST(sum(CASE WHEN sentiment = 'neutral' THEN n ELSE 0 END) AS BIGINT) AS neutral,
       CAST(sum(CASE WHEN sentiment = 'positive' THEN n ELSE 0 END) AS BIGINT) AS positive,
       CAST(sum(CASE WHEN sentiment IN ('negative', 'neutral', 'positive') THEN n ELSE 0 END) AS BIGINT) AS total
FROM ment GROUP BY topic
"""


ORACLE["run_sentiment_report_input"] = f"""
WITH {REPLIES}
SELECT run_id, '请帮我对 the 事件进行总结，它的累计情感统计:' || chr(10)
       || 'Positive: ' || CAST(sum(CAST(json_extract(clean, '$.summary.positive') AS BIGINT)) AS VARCHAR) || chr(10)
       || 'Neutral: ' || CAST(sum(CAST(json_extract(clean, '$.summary.neutral') AS BIGINT)) AS VARCHAR) || chr(10)
       || 'Negative: ' || CAST(sum(CAST(json_extract(clean, '$.summary.negative') AS BIGINT)) AS VARCHAR) AS text
FROM okr WHERE kind = 'sentiment' GROUP BY run_id
"""

ORACLE["run_topic_report_input"] = f"""
WITH {REPLIES}, c AS (SELECT run_id, topic, count(*) AS n FROM tment GROUP BY run_id, topic)
SELECT run_id, '请帮我对 the 事件进行总结，以下是各主题的讨论量统计：' || chr(10)
       || string_agg(topic || ': ' || n || chr(10), '' ORDER BY first_chunk, first_entry, first_pos) AS text
FROM registry JOIN c USING (run_id, topic) GROUP BY run_id
"""


# ---------------------------------------------------------------------- streaming

from opinio.plans.oracle import POST_LABELS as _PL  # noqa: E402
from opinio.plans.oracle import REQUESTS as _RQ  # noqa: E402
from opinio.plans.oracle import TSF  # noqa: E402

ORACLE["stream_hourly_counts"] = f"""
SELECT strftime(date_trunc('hour', ts), {TSF}) AS win_start, count(*) AS n FROM events GROUP BY 1
"""

ORACLE["stream_labels"] = f"""
WITH {_PL}
SELECT p.post_id, p.sentiment, coalesce(string_agg(t.topic, ', ' ORDER BY t.topic), '') AS topics
FROM plab p LEFT JOIN ptop t USING (post_id) GROUP BY p.post_id, p.sentiment
"""

ORACLE["stream_topic_registry"] = f"WITH {REPLIES} SELECT * FROM registry"

ORACLE["stream_late_rows"] = f"""
SELECT event_id, strftime(ts, {TSF}) AS ts, ts < TIMESTAMP '2024-01-04 00:00:00' AS late FROM events
"""

ORACLE["stream_requests"] = f"""
WITH {_RQ}
SELECT CAST(rv.request_id AS VARCHAR) AS request_id, rv.status, rok.keyword FROM rv LEFT JOIN rok USING (request_id)
UNION ALL
SELECT NULL, 'bad_line', NULL FROM rv WHERE request_id % 9 = 0
"""

# Three rounds: a chunk takes the topics that earlier rounds found, or names one of its own.
_ROUND = """
a{k} AS (SELECT run_id, chunk_id, CASE WHEN chunk_id % 10 = 3 THEN [] WHEN len(list_filter(c, lambda x: list_contains(l, x))) > 0
                THEN list_filter(c, lambda x: list_contains(l, x)) WHEN len(c) > 0 THEN [c[chunk_id % len(c) + 1]] ELSE [] END AS t
         FROM fits, l{k} WHERE round = {k}),
l{n} AS (SELECT list_distinct(list_concat(any_value(l), flatten(list(t)))) AS l FROM l{k} LEFT JOIN a{k} ON true)"""

ORACLE["stream_topic_labelling"] = f"""
WITH {REPLIES},
lists AS (SELECT run_id, chunk_id, list_sort(list(DISTINCT topic)) AS c FROM ent JOIN ptop USING (post_id) GROUP BY ALL),
fits AS (SELECT DISTINCT e.run_id, e.chunk_id, coalesce(c, []) AS c,
                e.chunk_id * 3 // (SELECT max(chunk_id) + 1 FROM ent) AS round
         FROM ent e LEFT JOIN lists USING (run_id, chunk_id)),
l0 AS (SELECT CAST([] AS VARCHAR[]) AS l),{",".join(_ROUND.format(k=k, n=k + 1) for k in range(3))}
SELECT run_id, chunk_id, CASE WHEN chunk_id % 10 = 3 THEN 'call_failed' ELSE 'ok' END AS status, array_to_string(t, ', ') AS topics
FROM (SELECT * FROM a0 UNION ALL SELECT * FROM a1 UNION ALL SELECT * FROM a2)
"""

ORACLE["stream_topic_sentiment"] = f"""
WITH {_PL}
SELECT t.topic, count(*) FILTER (WHERE p.sentiment = 'negative') AS negative,
       count(*) FILTER (WHERE p.sentiment = 'neutral') AS neutral,
       count(*) FILTER (WHERE p.sentiment = 'positive') AS positive, count(*) AS total
FROM ptop t JOIN plab p USING (post_id) GROUP BY t.topic
"""

ORACLE["stream_asked_windows"] = f"""
WITH ev AS (SELECT event_id, ts, user_id AS request_id FROM events),
asked AS (SELECT request_id, date_trunc('day', min(ts)) + to_days(CAST((request_id % 3 + 3) % 3 AS INTEGER)) AS lo FROM ev WHERE request_id IS NOT NULL GROUP BY request_id),
mark AS (SELECT epoch_us(max(ts)) // 1000 * 1000 - 28 * 86400000000 AS us FROM ev WHERE ts >= TIMESTAMP '2024-01-04' AND request_id IS NOT NULL),
landed AS (SELECT *, coalesce(ts >= TIMESTAMP '2024-01-04', false) AS first_part FROM ev),
counted AS (SELECT request_id, event_id, ts, first_part,
                   sum(CASE WHEN first_part THEN 1 + (event_id % 5 = 0)::INT + (event_id % 7 = 0)::INT ELSE 1 END)::BIGINT AS n_rows
            FROM landed GROUP BY ALL)
SELECT c.request_id, c.event_id, strftime(c.ts, {TSF}) AS ts, n_rows,
       CASE WHEN c.ts >= lo AND c.ts <= lo + INTERVAL 20 DAY
            THEN CASE WHEN first_part OR epoch_us(c.ts) > (SELECT us FROM mark) THEN 'on_time' ELSE 'late' END
            ELSE 'outside' END AS fate
FROM counted c LEFT JOIN asked a ON a.request_id = c.request_id
"""
