"""DuckDB SQL for the corpus queries that SQL can express."""

LLM_ORACLE: dict[str, str] = {}

LLM_ORACLE["op8_block_naming"] = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
), g as (select t, min(doc_id) as keep_id, count(*) as group_size from n group by t)
select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept, sha256(n.t) as text_sha256
from n join g using (t)
"""

LLM_ORACLE["op3_minhash_bayes"] = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g
  from w
), n as (select doc_id, count(*) as n from s group by doc_id
), p as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all
), l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)
), e as (select a, b from l union all select b, a from l
), r as (
  select doc_id, doc_id as c from documents
  union
  select e.b, r.c from r join e on e.a = r.doc_id
), c as (select doc_id, min(c) as component_id from r group by doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join n using (doc_id) join c using (doc_id)
"""

# The blocks that a source fills are the first ones of its repeated order, so a document's taken words are
# its overlap with that prefix.
LLM_ORACLE["op2_golden_ratio_mix"] = r"""
with recursive d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         coalesce(md5(text), '') as text_key, md5('mix:' || coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '')) as o
  from documents
), s0 as (select source, sum(size)::bigint as source_size from d group by source
), s as (
  select *, ([5, 2, 1])[1 + number % 3]::bigint as weight
  from (select *, row_number() over (order by source nulls last) - 1 as number from s0)
), t as (
  select sum(source_size)::bigint as total, sum(weight)::bigint as weights, count(*) as n from s
), level as (
  select 0 as k, total / weights as v from t
  union all
  select l.k + 1, (any_value(t.total) - sum(case when 3 * source_size < v * weight then 3 * source_size else 0 end))::bigint
                  / sum(case when 3 * source_size < v * weight then 0 else weight end)::bigint
  from level l, s, t where l.k < 40 group by l.k
), v as (select v from level where k = 40
), g as (
  select s.*, case when 3 * source_size < v * weight then (3 * source_size)::double else v * weight end as target,
         (sum(case when 3 * source_size < v * weight then 3 * source_size else 0 end) over (order by number))::double
         + v * (sum(case when 3 * source_size < v * weight then 0 else weight end) over (order by number))::double as high
  from s, v
), b as (
  select any_value(total) as total, any_value(n) as n,
         greatest(1, least(1024, floor(min(target) filter (target > 0))::bigint // 256)) as words from t, g
), iv as (
  select g.*, coalesce(lag(high) over (order by number), 0) as low,
         case when number = n - 1 then 2.0 * total else high end as top
  from g, b
), slots as (
  -- i times 2^72 / golden ratio (limbs 8132083, 12156746, 10368889 of 24 bits), modulo 2^72; the upper 48 bits
  select ((r2 % 16777216) * 16777216 + r1 % 16777216 + 0.5) / 281474976710656::double * total as x
  from (select *, r1 // 16777216 + lo * 10368889 + hi * 12156746 as r2
        from (select *, lo * 8132083 // 16777216 + lo * 12156746 + hi * 8132083 as r1
              from (select i % 16777216 as lo, i // 16777216 as hi, total
                    from b, range((select (total + words - 1) // words from b)) r(i))))
), held as (
  select number, count(*) as k from slots join iv on x >= low and x < top group by number
), p as (
  select d.*, source_size, target, coalesce(k, 0) * words as lim,
         (sum(size) over (partition by number order by o, doc_id nulls last, text_key))::bigint - size as start
  from d join iv on d.source is not distinct from iv.source left join held using (number), b
)
select doc_id, size, source_size, target,
       (greatest(0, least(start + size, lim) - least(start, lim))
        + greatest(0, least(start + source_size + size, lim) - least(start + source_size, lim))
        + greatest(0, least(start + 2 * source_size + size, lim) - least(start + 2 * source_size, lim)))::bigint as taken
from p
"""

LLM_ORACLE["op1_pq_neardup"] = r"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
), ok as (
  select * from v where label is not null and e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
         and len(list_filter(e, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93
), r as (
  select vec_id, vec_id as c from v union select l.b, r.c from r join l on l.a = r.vec_id
), c as (select vec_id, min(c) as component_id from r group by vec_id
), n as (select a as vec_id, count(*) as n from l group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from c left join n using (vec_id)
"""

LLM_ORACLE["op11_importance_resampling"] = r"""
with bits as (
  select list_transform(range(256), lambda b: list_reduce(list_concat([b::ubigint], range(8)::ubigint[]),
         lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384::ubigint) else c // 2 end)) as t
), texts as (
  select 0 as side, row_number() over () as r, doc_id, text from documents
  union all select 1, row_number() over (), null, text from benchmark
), words as (
  select side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from texts
), f as (select side, r, unnest(ws) as w from words
), named as (
  select w, xor(list_reduce(list_concat([4294967295::ubigint], list_transform(range(1, octet_length(encode(w)) + 1),
         lambda i: ('0x' || substr(hex(encode(w)), 2 * i::int - 1, 2))::ubigint)),
         lambda c, b: xor(c // 256, t[(xor(c, b) % 256)::int + 1])), 4294967295::ubigint) % 10000 as bucket
  from (select distinct w from f), bits
), counted as (
  select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from f join named using (w) group by bucket
), gain as (
  select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
                                 / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as g
  from counted
), weights as (
  select r, sum(g)::bigint as weight from f join named using (w) join gain using (bucket) where side = 0 group by r
), hashed as (
  select words.*, len(ws)::bigint as n_features, coalesce(weight, 0) as weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
  from words left join weights using (r) where side = 0
), scored as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from hashed
), ranked as (
  select r, row_number() over (order by score desc, doc_id nulls last, n_features desc) as k,
         10 * count(*) over () // 100 as drawn
  from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when k <= drawn then k end as rank
from scored left join ranked using (r)
"""

LLM_ORACLE["op12_filter_audit"] = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
), flags as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), fails as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
          100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) over (partition by t), false)] as f
  from d left join flags using (doc_id)
), letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l
), orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps as (
  select filter_order, step, list_transform(range(1, step::int + 1), lambda i: strpos('ABCDE', filter_order[i])) as done
  from orders, range(1, 6) s(step)
), seen as (
  select part, filter_order, step, good, toxic, f[done[step::int]] as fails_now,
         len(list_filter(done[1:step::int - 1], lambda i: f[i])) > 0 as gone_before, len(list_filter(f, lambda x: x)) = 1 as one
  from fails, steps
), counted as (
  select part, filter_order, step::int as step, count(*) filter (not gone_before and not fails_now) as kept,
         count(*) filter (fails_now and not gone_before) as removed, count(*) filter (fails_now and gone_before) as redundant,
         count(*) filter (fails_now and one) as unique_fails, count(*) filter (fails_now and not gone_before and good) as good_lost,
         count(*) filter (fails_now and not gone_before and toxic) as toxic_lost
  from seen group by all
)
select *, sum(removed) over (partition by part, filter_order[step])::bigint as shapley from counted
"""
