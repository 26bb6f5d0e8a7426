"""SQL for DuckDB that gives the results of the queries of the same names."""

from __future__ import annotations

_P1 = """
with t as (
  select *, cast(greatest(coalesce(min_rows, 0), round(coalesce(target_share, 0) * coalesce(sample_rows, 0))) as bigint) as needed from sample_target
), o as (
  select t.cate_1_depth a, t.cate_2_depth b, t.sc_measurement c, count(distinct d.memo_id) n
  from (select distinct cate_1_depth, cate_2_depth, sc_measurement from sample_target) t join classification_detail d
    on d.cate_1_depth is not distinct from t.cate_1_depth and d.cate_2_depth is not distinct from t.cate_2_depth and d.sc_measurement is not distinct from t.sc_measurement
  where d.memo is not null and length(trim(d.memo, ' ')) > 0 group by all
), r as (
  select t.*, coalesce(o.n, 0) as observed from t left join o
    on o.a is not distinct from t.cate_1_depth and o.b is not distinct from t.cate_2_depth and o.c is not distinct from t.sc_measurement
)
"""

_P1_SAMPLE = _P1.rstrip() + """, g as (select cate_1_depth, cate_2_depth, sc_measurement, max(needed) as needed from t group by all),
u as (
  select g.cate_1_depth, g.cate_2_depth, g.sc_measurement, g.needed, d.memo_id, min(d.detail_id) as detail_id
  from g join classification_detail d on d.cate_1_depth is not distinct from g.cate_1_depth and d.cate_2_depth is not distinct from g.cate_2_depth and d.sc_measurement is not distinct from g.sc_measurement
  where d.memo is not null and length(trim(d.memo, ' ')) > 0 and d.memo_id is not null group by all
)
select cate_1_depth, cate_2_depth, sc_measurement, memo_id, detail_id from u
qualify row_number() over (partition by cate_1_depth, cate_2_depth, sc_measurement order by substr(md5(concat_ws('||', '20260420', coalesce(cate_1_depth, ''), coalesce(cate_2_depth, ''), coalesce(cast(sc_measurement as varchar), ''), memo_id)), 1, 12), memo_id) <= needed
"""

_P6 = """
select cate_2_depth, pred_topic, detail_id, confidence_score, "rank" from (
  select *, cast(row_number() over (partition by cate_2_depth, pred_topic order by confidence_score desc, detail_id) as integer) as "rank"
  from classification_detail where cate_2_depth is not null and pred_topic is not null and confidence_score is not null and not isnan(confidence_score)
) where "rank" <= 5
"""

_WORDS = "regexp_extract_all(lower(nfc_normalize(text)), '[\\p{L}\\p{N}]+')"

_P9 = f"""
with d as (select doc_id, {_WORDS} w from documents where text is not null),
i as (select item_id, {_WORDS} w from eval_item where text is not null),
dw as (select doc_id, unnest([array_to_string(list_slice(w, k, k + 12), ' ') for k in range(1, len(w) - 11)]) g from d where len(w) >= 13),
iw as (select item_id, unnest([array_to_string(list_slice(w, k, k + 12), ' ') for k in range(1, len(w) - 11)]) g from i where len(w) >= 13)
select distinct doc_id, item_id from dw join iw using (g)
"""

_SHOWN = "replace(replace(lower(nfc_normalize(regexp_replace(memo, '\\p{Cf}', '', 'g'))), 'ı', 'i'), 'i̇', 'i')"
_SEQ = lambda c: f"regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]', '', 'g')"

# seq: letters and digits; f: sorted fields of a list of three or more, else null
_MEMOS = f"""
m0 as (select detail_id, cate_1_depth, cate_2_depth, sc_measurement, {_SHOWN} as shown from classification_detail where memo is not null),
m1 as (select *, {_SEQ('shown')} as seq, list_filter(regexp_split_to_array(shown, '[;|\\n\\r]+'), lambda p: {_SEQ('p')} <> '') as parts from m0),
m as (
  select *, case when len(parts) >= 3 and len(list_filter(parts, lambda p: {_SEQ("regexp_extract(p, '^([^:=]*)[:=]', 1)")} <> '' and {_SEQ("regexp_extract(p, '^[^:=]*[:=]((?s).*)$', 1)")} <> '')) = len(parts)
    then array_to_string(list_sort(list_transform(parts, lambda p: {_SEQ("regexp_extract(p, '^([^:=]*)[:=]', 1)")} || chr(31) || {_SEQ("regexp_extract(p, '^[^:=]*[:=]((?s).*)$', 1)")})), chr(30)) end as f
  from m1
)
"""

_P2 = f"""
with {_MEMOS},
w as (select detail_id as id, unnest(regexp_extract_all(shown, '[\\p{{L}}\\p{{N}}]+')) as word from m),
t as (select id, word || '#' || row_number() over (partition by id, word) as tok from w),
n as (select id, count(*) as n from t group by id having count(*) >= 8),
d as (select tok, count(*) as df from t group by tok),
r as (select t.id, t.tok, n.n, row_number() over (partition by t.id order by d.df, t.tok) as k from t join n using (id) join d using (tok)),
p as (select * from r where k <= n - ceil(0.8 * n) + 1),
c as (select distinct a.id as a, b.id as b, a.n + b.n as n from p a join p b using (tok) where a.id < b.id and least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
o as (select c.a, c.b, c.n, count(*) as o from c join r x on x.id = c.a join r y on y.id = c.b and y.tok = x.tok group by all)
select o.a as id_a, o.b as id_b from o join m x on x.detail_id = o.a join m y on y.detail_id = o.b
where o.o >= 0.8 * (o.n - o.o) - 1e-9 and x.seq <> y.seq and not coalesce(x.f = y.f, false)
"""

_P3 = f"""
with {_MEMOS},
k as (select *, coalesce(min(f) over (partition by cate_1_depth, cate_2_depth, sc_measurement, seq), seq) as c from m where length(seq) >= 20),
g as (select detail_id, min(detail_id) over (partition by cate_1_depth, cate_2_depth, sc_measurement, c) as first_id from k)
select distinct first_id, detail_id as copy_id from g where detail_id > first_id
"""

_V = """
v as (
  select memo_id, min(cast(embedding as double[])) as e from memo_embedding
  where embedding_model = 'stub-encoder-64' and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
  group by memo_id
),
s as (select a.memo_id as a, b.memo_id as b, list_cosine_similarity(a.e, b.e) as cosine from v a join v b on a.memo_id <> b.memo_id)
"""

_P4 = f"""
with recursive {_V},
e as (select a, b from s where cosine >= 0.8),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
c as (select a as memo_id, least(a, min(b)) as first_id from r group by a)
select first_id, memo_id from c where memo_id <> first_id and first_id in (select first_id from c group by first_id having count(*) >= 3)
"""

_P7 = f"""
with {_V}, k as (select * from s where cosine >= 0.8 qualify row_number() over (partition by a order by cosine desc, b) <= 5)
select distinct least(a, b) as id_a, greatest(a, b) as id_b from k
"""

SQL = {
    "p1_found": _P1 + "select cate_1_depth, cate_2_depth, sc_measurement from r where observed < needed",
    "p1_sample": _P1_SAMPLE,
    "p1_report": _P1 + "select cate_1_depth, cate_2_depth, sc_measurement, needed, observed, least(needed, observed) as drawn, needed - least(needed, observed) as deficit from r",
    "p2_found": _P2,
    "p3_found": _P3,
    "p3_counts": f"select first_id, count(*) + 1 as copies from ({_P3}) group by first_id",
    "p4_found": _P4,
    "p7_found": _P7,
    "p6_found": f"select cate_2_depth, pred_topic, detail_id from ({_P6})",
    "p6_ranked": _P6,
    "p9_found": _P9,
}
