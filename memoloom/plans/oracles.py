"""SQL for DuckDB that gives the results of the core queries of the same names."""

from __future__ import annotations

_G, _V = "cate_1_depth, cate_2_depth, sc_measurement", "prompt_version, taxonomy_version, model_version"
_GV = f"{_G}, {_V}"


def _on(a: str, b: str, names: str) -> str:
    return " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in names.replace(" ", "").split(","))


_TEXT = lambda c: f"coalesce(cast({c} as varchar), '')"
_KEY = lambda *p: "concat_ws('||', " + ", ".join(p) + ")"
_NORM = "trim(regexp_replace(regexp_replace(lower(replace(coalesce(memo, ''), '　', ' ')), '[^0-9a-zA-Z가-힣\\s]', ' ', 'g'), '\\s+', ' ', 'g'), ' ')"
_ID = "sha256(" + _KEY(*map(_TEXT, _G.split(", ")), "memo_norm") + ")"
_CLEAN = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '[\\s\\x{{0b}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g'), ' ')"
_TOKENS = lambda c: f"list_distinct(list_filter(string_split(lower({_CLEAN(c)}), ' '), lambda t: t <> ''))"
_SAMPLE = lambda seed: "md5(" + _KEY(_TEXT("memo_id"), f"'{seed}'") + ")"
_SAMPLE_G = lambda seed: "md5(" + _KEY(_TEXT("memo_id"), *map(_TEXT, _G.split(", ")), f"'{seed}'") + ")"

_ELIGIBLE = """not coalesce(starts_with(cate_1_depth, '***'), false) and not coalesce(starts_with(cate_2_depth, '***'), false)
  and sc_measurement in (1, -1) and memo is not null and length(trim(memo, ' ')) > 0"""

_RAW = f"""
with raw as (select detail_id, {_G}, year, country, brand_name, device_type, memo from classification_detail),
n as (select *, {_NORM} as memo_norm from raw where {_ELIGIBLE}),
memos as (select *, {_ID} as memo_id from n),
one as (select * from memos qualify row_number() over (partition by {_G}, memo_id order by year nulls last, country nulls last, brand_name nulls last, device_type nulls last, memo nulls last, detail_id) = 1)
"""

_LATEST = f"""
with n0 as (select * exclude (memo_norm, memo_id), {_NORM} as memo_norm from classification_detail),
n1 as (select *, {_ID} as memo_id from n0),
latest as (select * from n1 qualify row_number() over (partition by {_GV}, memo_id order by is_latest desc nulls last, created_at desc nulls last, run_id desc nulls last, detail_id nulls last) = 1)
"""

_SCORE = "case when isnan(confidence_score) then null else confidence_score end"
_IF = lambda cond: f"cast(count(*) filter (where {cond}) as bigint)"
_OTHERS = "pred_topic_type = 'others'"
_RATIO = lambda a, b: f"case when {b} > 0 then {a} / {b} else 0.0 end"

_CAND = f"""
with c as (
  select {_G}, memo_norm, count(*) as candidate_cnt, count(distinct memo_id) as distinct_memo_id_cnt, min(memo) as sample_memo
  from classification_detail where {_OTHERS} and coalesce(memo_norm, '') <> '' group by all
), r as (select *, cast(sum(candidate_cnt) over (partition by {_G}) as bigint) as others_cnt from c),
k as (select *, candidate_cnt / others_cnt as candidate_ratio from r)
"""

_SHARE = f"""
with n as (select {_G}, pred_topic, count(*) as review_count from classification_detail group by all),
share as (select *, cast(sum(review_count) over (partition by {_G}) as bigint) as group_count from n)
"""

_MAP = "(select distinct cate_1_depth, cate_2_depth, sc_measurement, topic as source_topic, string_split(topic, ' ')[1] as merged_topic from topic_pool where topic like '% %')"

_LABELS = """
with m as (select cate_1_depth, cate_2_depth, min(cate_1_depth_kor) k1, min(cate_2_depth_kor) k2 from category_mapping group by all),
d as (select c.*, coalesce(m.k1, c.cate_1_depth) as cate_1_label, coalesce(m.k2, c.cate_2_depth) as cate_2_label from classification_detail c left join m using (cate_1_depth, cate_2_depth))
"""

_VECTORS = f"""
with ok as (
  select * replace (case when isnan(confidence_score) then null else confidence_score end as confidence_score) from memo_embedding where embedding_model = 'stub-encoder-64' and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x))) = 0
), v as (
  select * from ok qualify row_number() over (partition by {_GV}, memo_id, embedding_model order by created_at desc nulls last, run_id desc nulls last, pred_topic nulls last) = 1
), known as (
  select {_GV}, pred_topic, embedding_model, count(*) as memo_cnt, count(distinct memo_id) as distinct_memo_cnt, avg(confidence_score) as avg_confidence
  from v group by all having count(distinct memo_id) >= 3
), pos as (
  select {_GV}, pred_topic, embedding_model, i, avg(cast(embedding[i] as double)) as x from v, range(1, 65) t(i) group by all
), mean as (
  select {_GV}, pred_topic, embedding_model, list(x order by i) as m, sqrt(sum(x * x)) as len from pos group by all
), proto as (
  select known.*, list_transform(m, lambda e: e / nullif(len, 0)) as prototype from known join mean using ({_GV}, pred_topic, embedding_model)
)
"""

_ROUTED = _VECTORS + f""", q as (
  select *, list_transform(embedding, lambda e: cast(e as double) / nullif(sqrt(list_sum(list_transform(embedding, lambda y: cast(y as double) * cast(y as double)))), 0)) as u from v where len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select q.cate_1_depth, q.cate_2_depth, q.sc_measurement, q.prompt_version, q.taxonomy_version, q.model_version, q.embedding_model, q.memo_id, q.pred_topic as true_topic, proto.pred_topic as prototype_topic,
    proto.distinct_memo_cnt, list_dot_product(q.u, proto.prototype) as similarity
  from q join proto using ({_GV}, embedding_model)
), routed as (
  select *, case when similarity >= 0.82 then 'auto_accept' when similarity >= 0.70 then 'llm_fallback' else 'review_required' end as prototype_route
  from pairs where similarity is not null and not isnan(similarity)
  qualify row_number() over (partition by {_GV}, embedding_model, memo_id order by similarity desc, distinct_memo_cnt desc, prototype_topic nulls first) = 1
)
"""

_APPROVED = f"""
with a as (
  select * from review_decision where decision_status = 'approved' and approved_action in ('reassign_existing_topic', 'keep_others') and coalesce(memo_id, '') <> ''
  qualify row_number() over (partition by {_G}, memo_id, {_V} order by reviewed_at desc nulls last, created_at desc nulls last, decision_id nulls last) = 1
)
"""

# The lexical classifier

_LOW = lambda c: f"lower({_CLEAN(c)})"
_LABEL = lambda c: f"list_filter(regexp_split_to_array(regexp_replace({_CLEAN(c)}, '^\\d+-\\d+\\.\\s*', ''), '[/()\\-_,\\s]+'), lambda t: t <> '')"
_PHRASE = lambda c: f"trim(regexp_replace({_LOW(c)}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+', ' ', 'g'), ' ')"
_SPACED = lambda c: f"(' ' || replace({c}, ' ', '  ') || ' ')"
_JSON = lambda c: f"case when {_CLEAN(c)} = '' then []::varchar[] when json_type(try_cast({c} as json)) = 'ARRAY' then cast(try_cast({c} as json) as varchar[]) else [{c}] end"
_CLEANED = lambda x: f"list_filter(list_transform(coalesce({x}, []::varchar[]), lambda t: {_CLEAN('t')}), lambda t: t <> '')"
_FIRST = lambda x, n: f"list_slice(list_filter({x}, lambda t, i: list_position(list_transform({x}, lambda u: lower(u)), lower(t)) = i), 1, {n})"
_TERMS = lambda x, n: _FIRST(_CLEANED(x), n)
_LOWS = lambda x: f"list_filter(list_transform({x}, lambda t: {_LOW('t')}), lambda t: t <> '')"
_LONGEST = lambda x: f"list_transform(list_sort(list_transform({x}, lambda t: {{'n': -length(t), 't': t}})), lambda e: e.t)"
_PHRASES = lambda x: f"list_transform({_LONGEST(f'list_filter(list_transform({x}, lambda t: {_PHRASE(chr(116))}), lambda t: t <> {chr(39) * 2})')}, lambda t: {_SPACED('t')})"
_ANY = lambda x, terms: f"(len(list_filter({terms}, lambda q: contains({x}, q))) > 0)"
_TOKEN_LIST = lambda c: f"list_filter(string_split({_LOW(c)}, ' '), lambda t: t <> '')"
_WITHOUT = lambda x, terms: f"trim(regexp_replace(list_reduce(list_prepend({x}, {terms}), lambda acc, t: replace(acc, t, '')), ' +', ' ', 'g'), ' ')"
_STRIPPED = lambda x, terms: _CLEAN(f"list_reduce(list_prepend(' ' || {x} || ' ', {terms}), lambda acc, t: replace(acc, ' ' || t || ' ', ' '))")


def _near(low: str, tokens: str, targets: str, reasons: str, gap: int, reach: int = 40) -> str:
    place = lambda x: f"list_filter(list_transform({x}, lambda t: instr({low}, t)), lambda i: i > 0)"
    hit = lambda x: f"list_filter(list_transform({tokens}, lambda w, i: case when len(list_filter({x}, lambda t: contains(w, t) or (contains(t, w) and list_contains(string_split(t, ' '), w)))) > 0 then i end), lambda i: i is not null)"
    meet = lambda a, b, n: f"(len(list_filter({a}, lambda i: len(list_filter({b}, lambda j: abs(i - j) <= {n})) > 0)) > 0)"
    return f"({meet(place(targets), place(reasons), reach)} or {meet(hit(targets), hit(reasons), gap)})"


_OVERALL = "case when sc_measurement = 1 then '전반적 긍정' when sc_measurement = -1 then '전반적 부정' else '전반적 평가' end"
_TOPICS = f"""
tp0 as (select {_G}, topic, coalesce(description, '') as description, list_slice(list_filter({_JSON('representative_memos_json')}, lambda m: {_CLEAN('m')} <> ''), 1, 10) as memos from topic_pool where {_CLEAN('topic')} <> ''),
tp1 as (select * from tp0 qualify row_number() over (partition by {_G}, topic order by description, memos) = 1),
tp2 as (select *, {_LABEL('topic')} as named, {_LABEL('description')} as told, flatten(list_transform(memos[1:5], lambda m: list_slice(list_filter({_LABEL('m')}, lambda t: length(t) >= 4), 1, 5))) as shown from tp1),
tp3 as (select *, {_TERMS('told', 50)} as told50 from tp2),
tp4 as (select *, list_concat(list_concat(named, told50), list_concat(told, shown)) as all_hints from tp3),
tp5 as (select *, {_CLEANED('all_hints')} as cleaned from tp4),
top as (select {_G}, topic, description, memos, list_transform({_FIRST('cleaned', 40)}, lambda t: lower(t)) as hints, lower(topic) as low_name, lower(description) as low_told, {_TOKENS('topic')} as name_t, {_TOKENS('description')} as told_t, {_TOKENS("array_to_string(memos, ' ')")} as shown_t from tp5)"""
_PROFILE = f"""
pr0 as (select * from topic_pool qualify row_number() over (partition by {_G} order by created_at desc nulls last, topic_order, topic) = 1),
pr1 as (select {_G}, coalesce(overall_topic_name, {_OVERALL}) as overall_topic_name, {_JSON('rule_profile_overall_sentiment_terms_json')} as s, {_JSON('rule_profile_feature_hint_terms_json')} as f, {_JSON('rule_profile_reason_signal_terms_json')} as r from pr0),
prof as (select {_G}, overall_topic_name, {_TERMS('s', 40)} as sentiment, {_TERMS('f', 100)} as feature, {_TERMS('r', 100)} as reason from pr1)"""
_GROUPS = f"""
gt0 as (select {_G}, list_slice(list_sort(list(topic)), 1, 20) as named from top group by all),
gt1 as (select prof.*, coalesce(named, []::varchar[]) as named, list_concat({_LABEL('prof.cate_1_depth')}, {_LABEL('prof.cate_2_depth')}) as labels from prof left join gt0 using ({_G})),
gt2 as (select *, list_concat(labels, {_TERMS('labels', 50)}) as base, list_filter(feature[1:30], lambda t: len(string_split({_CLEAN('t')}, ' ')) <= 2) as short, flatten(list_transform(named, lambda x: {_LABEL('x')})) as of_topics from gt1),
gt3 as (select *, {_TERMS('base', 50)} as targets, list_concat(list_concat(base, short), of_topics) as around from gt2),
gt4 as (select *, {_CLEANED('around')} as around_c from gt3),
gt5 as (select *, {_FIRST('around_c', 80)} as neutral from gt4),
gt as (select {_G}, overall_topic_name, feature, sentiment, neutral as neutral_terms, {_LOWS('sentiment')} as said, {_LOWS('feature')} as features, {_LOWS('reason')} as reasons, {_LONGEST(_LOWS('neutral'))} as neutral, {_PHRASES('targets')} as target_p, {_PHRASES('sentiment')} as sentiment_p, {_PHRASES('list_concat(targets, sentiment)')} as pure_p from gt5)"""
_CONNECTORS = f"conn0 as (select w, count(*) as n from (select unnest(list_distinct(string_split({_PHRASE('memo')}, ' '))) as w from n) where w <> '' group by w order by n desc, w limit 30),"
_RULED = _RAW.rstrip() + f""",{_TOPICS},{_PROFILE},{_GROUPS},
conn0 as (select null::varchar as w where false),
conn as (select coalesce(list(w), []::varchar[]) as connectors from conn0),
me as (select {_G}, memo_id, memo, {_LOW('memo')} as low, {_TOKEN_LIST('memo')} as token_list, {_SPACED(_PHRASE('memo'))} as spaced, length({_CLEAN('memo')}) as n from one),
me1 as (select me.*, gt.* exclude (cate_1_depth, cate_2_depth, sc_measurement), connectors from me join gt using ({_G}), conn),
me2 as (select *, n > 0 and n <= 40 and {_ANY('spaced', 'target_p')} and {_ANY('spaced', 'sentiment_p')}
    and len(list_filter(string_split({_WITHOUT('spaced', 'pure_p')}, ' '), lambda t: t <> '' and not list_contains(connectors, t))) = 0 as pure, {_ANY('low', 'said')} as has_said from me1),
ru as (select *, case when pure then 'rule_overall_target_sentiment' when not has_said then 'rule_non_overall'
    when {_near('low', 'token_list', 'neutral', 'features', 5)} or {_ANY(_STRIPPED('low', 'neutral'), 'features')} or {_near('low', 'token_list', 'neutral', 'reasons', 4)} then 'rule_overall_blocked'
    when n <= 40 then 'rule_overall' else 'rule_non_overall' end as rule from me2)"""


def _scores(rows: str, features: str, overall: str) -> str:
    """CTE ``sc``: score and place of each topic of the rows, which have memo_id, low, memo and the columns named."""
    return f"""
sc0 as (select m.cate_1_depth, m.cate_2_depth, m.sc_measurement, m.memo_id, top.topic,
    cast(round(1.20 * len(list_intersect({_TOKENS('m.memo')}, name_t)) + 0.85 * len(list_intersect({_TOKENS('m.memo')}, told_t)) + 0.05 * len(list_intersect({_TOKENS('m.memo')}, shown_t))
      + coalesce(list_sum(list_transform({features}, lambda f: case when f = '' or not contains(m.low, f) then 0 when contains(low_name, f) then 1.25 when contains(low_told, f) then 0.85 else 0 end)), 0)
      + coalesce(list_sum(list_transform(list_filter(hints, lambda h: h <> '' and contains(m.low, h)), lambda h: case when contains(h, ' ') then 2.0 else 1.4 end)), 0), 4) as double) as score
  from {rows} m join top using ({_G}) where topic is distinct from {overall}),
sc as (select *, row_number() over (partition by {_G}, memo_id order by score desc, topic) as place from sc0 where score > 0 qualify place <= 5),
sl as (select {_G}, memo_id, max(case when place = 1 then topic end) as topic, max(case when place = 1 then score end) as score, coalesce(max(case when place = 2 then score end), 0) as second,
    '[' || string_agg('{{"topic":' || to_json(topic) || ',"score":' || cast(score as varchar) || '}}', ',' order by place) || ']' as shortlist from sc group by all)"""


_CLASSIFIED = _RULED + f""", op as (select * from ru where rule not in ('rule_overall', 'rule_overall_target_sentiment')),{_scores('op', 'm.features', 'm.overall_topic_name')},
cl0 as (select ru.*, sl.topic as best, sl.score as s1, round(sl.score - sl.second, 4) as margin, sl.shortlist, rule in ('rule_overall', 'rule_overall_target_sentiment') as by_rule from ru left join sl using ({_G}, memo_id)),
cl as (select {_G}, memo_id, memo,
    case when by_rule then overall_topic_name when best is null then '기타' when s1 >= 0.35 and margin >= 0.08 then best else '기타' end as pred_topic,
    case when by_rule then 'overall' when best is null then 'others' when s1 >= 0.35 and margin >= 0.08 then 'topic' else 'ambiguous' end as pred_topic_type,
    case when by_rule then rule when best is null then 'forced_others' when s1 >= 0.35 and margin >= 0.08 then 'heuristic_topic_match' else 'ambiguous_candidate_match' end as classification_stage,
    case when by_rule then 0.99::double when best is null then 0.0::double else s1 end as confidence_score,
    case when by_rule then false when best is null then true when s1 >= 0.35 and margin >= 0.08 then false else true end as review_needed_yn,
    case when by_rule then case when rule = 'rule_overall' then 'pure_sentiment_short_memo' else 'pure_category_target_sentiment' end when best is null then 'no_topic_candidate'
      else printf('top_score=%.4f;margin=%.4f', s1, margin) end as match_reason,
    coalesce(shortlist, '[]') as candidate_topics_json, false as llm_used_yn from cl0)"""
_NAMED = lambda reason, names: f"case when len(list_filter({names}, lambda t: t <> '' and contains(coalesce({reason}, ''), t))) = 1 then list_filter({names}, lambda t: t <> '' and contains(coalesce({reason}, ''), t))[1] end"
_REASSIGNED = _LATEST.rstrip() + f""",{_TOPICS},
ot as (select {_G}, memo_id, memo, match_reason, memo_norm, pred_topic, pred_topic_type, {_LOW('memo')} as low from latest where pred_topic_type = 'others'
    qualify row_number() over (partition by {_G}, memo_id order by memo nulls last, match_reason nulls last, memo_norm nulls last, pred_topic nulls last) = 1),
nm as (select {_G}, list_sort(list(topic)) as names from top group by all),{_scores('ot', '[]::varchar[]', "''")},
ra0 as (select ot.*, {_NAMED('match_reason', 'names')} as named, sl.topic as best, sl.score as s1, sl.score - sl.second as margin from ot join nm using ({_G}) left join sl using ({_G}, memo_id)),
ra as (select {_G}, memo_id, memo_norm, memo as sample_memo, pred_topic as current_pred_topic, pred_topic_type as current_pred_topic_type,
    coalesce(named, case when s1 >= 0.8 and margin >= 0 then best end) as suggested_topic, case when named is not null then 9.0::double when s1 >= 0.8 and margin >= 0 then s1 end as suggestion_score from ra0)"""

# The stand-ins for models

_SAMPLED = _RAW.rstrip() + f""", ds as (select * from memos qualify row_number() over (partition by memo_id order by memo nulls last, detail_id) = 1),
lg as (select {_G} from ds group by all having count(distinct memo_id) >= 20), ds1 as (select ds.* from ds join lg using ({_G})),
ba as (select *, concat_ws('||', coalesce(year, 'unknown_year'), coalesce(country, 'unknown_country'), coalesce(brand_name, 'unknown_brand'), coalesce(device_type, 'unknown_dtype'),
    case when length(memo_norm) <= 25 then 'short' when length(memo_norm) <= 80 then 'medium' else 'long' end) as stratum
  from ds1 qualify row_number() over (partition by {_G} order by {_SAMPLE_G('seed_20260420')}, memo_id) <= 800),
tu as (select *, row_number() over (partition by {_G}, stratum order by {_SAMPLE('seed_20260420')}, memo_id) as w from ba),
sa as (select {_G}, memo, row_number() over (partition by {_G} order by w, md5(concat_ws('||', stratum, memo_id, 'seed_20260420')), memo_id) as prompt_rn from tu qualify prompt_rn <= 200),
wd as (select {_G}, word, count(*) as n from (select {_G}, prompt_rn, unnest(list_distinct(regexp_extract_all(lower(memo), '[\\p{{L}}\\p{{Nl}}\\p{{No}}]{{4,}}'))) as word from sa) group by all),
be as (select *, row_number() over (partition by {_G} order by n desc, word) as k from wd qualify k <= 12),
bw as (select {_G}, list(word order by k) as best from be group by all),
mm as (select {_G}, list(memo order by prompt_rn) as memos, list({_CLEAN('memo')} order by prompt_rn) as shown from sa group by all)"""
_SHOWN_TERMS = lambda n, most: f"array_to_string(list_slice({_TERMS(f'memos[1:{n}]', most)}, 1, {most}), '|')"

SQL = {
    "s1_scan": "select detail_id, memo_id, pred_topic from classification_detail where cate_1_depth = '01. Picture' and sc_measurement = 1",
    "s2_eligible": f"select detail_id, {_G} from classification_detail where {_ELIGIBLE}",
    "s6_source_filter": "select detail_id, year, device_type from classification_detail where year >= '2023' and device_type is not null",
    "f1_memo_norm": f"select detail_id, {_NORM} as memo_norm from classification_detail",
    "f3_memo_id": _RAW + "select detail_id, memo_id from memos",
    "f4_decision_key": "select decision_id, sha256(" + _KEY(*map(_TEXT, ["candidate_type", *_G.split(", "), "memo_id", "suggested_topic", *_V.split(", ")])) + ") as surrogate from review_decision",
    "f5_sampling_key": f"select detail_id, {_SAMPLE_G('seed_20260420')} as sampling_key from classification_detail",
    "f6_clean_text": f"select {_G}, topic_order, {_CLEAN('description')} as description from topic_pool",
    "f8_token_count": f"select detail_id, cast(len({_TOKENS('memo')}) as integer) as tokens from classification_detail",
    "f14_label_tokens": f"select cate_1_depth, cate_2_depth, array_to_string(list_filter(regexp_split_to_array(regexp_replace({_CLEAN('cate_2_depth')}, '^\\d+-\\d+\\.\\s*', ''), '[/()\\-_,\\s]+'), lambda t: t <> ''), '/') as tokens from category_mapping",
    "f19_stratum": _RAW + f""", s as (select *, concat_ws('||', coalesce(year, 'unknown_year'), coalesce(country, 'unknown_country'), coalesce(brand_name, 'unknown_brand'), coalesce(device_type, 'unknown_dtype'),
        case when length(memo_norm) <= 25 then 'short' when length(memo_norm) <= 80 then 'medium' else 'long' end) as stratum from memos)
        select {_G}, stratum, count(*) as row_cnt from s group by all""",
    "trusted_labels": """select detail_id, pred_topic from classification_detail where memo_id is not null and pred_topic is not null and pred_topic <> '기타' and pred_topic_type in ('topic', 'overall')
        and (classification_stage in ('llm_fallback', 'llm_reason_recovered', 'rule_overall', 'rule_overall_target_sentiment') or (classification_stage = 'heuristic_topic_match' and coalesce(case when isnan(confidence_score) then null else confidence_score end, 0) >= 0.6))
        and coalesce(is_latest, true) and not coalesce(review_needed_yn, false)""",
    "w1_dedupe": _RAW + "select memo_id, detail_id from memos qualify row_number() over (partition by memo_id order by memo nulls last, detail_id) = 1",
    "w2_dedupe": _RAW + "select memo_id, detail_id from one",
    "a1_groups": _RAW + f"select {_G}, count(distinct memo_id) as memo_cnt from memos group by all having count(distinct memo_id) >= 20",
    "w3_group_sample": _RAW + f"select {_G}, memo_id, cast(row_number() over (partition by {_G} order by {_SAMPLE_G('seed_20260420')}, memo_id) as integer) as rn from one qualify rn <= 1000",
    "w4_w5_diverse_sample": _RAW + f""", base as (select *, concat_ws('||', coalesce(year, 'unknown_year'), coalesce(country, 'unknown_country'), coalesce(brand_name, 'unknown_brand'), coalesce(device_type, 'unknown_dtype'),
          case when length(memo_norm) <= 25 then 'short' when length(memo_norm) <= 80 then 'medium' else 'long' end) as stratum
          from one qualify row_number() over (partition by {_G} order by {_SAMPLE_G('seed_20260420')}, memo_id) <= 800),
        turn as (select *, row_number() over (partition by {_G}, stratum order by {_SAMPLE('seed_20260420')}, memo_id) as w from base)
        select {_G}, memo_id, cast(row_number() over (partition by {_G} order by w, md5(concat_ws('||', stratum, memo_id, 'seed_20260420')), memo_id) as integer) as prompt_rn from turn qualify prompt_rn <= 200""",
    "o1_hash_sample": _RAW + f"select {_G}, memo_id from one qualify row_number() over (partition by {_G} order by {_SAMPLE('seed_20260707')}, memo_id) <= 1000",
    "w6_latest": _LATEST + "select memo_id, detail_id from latest",
    "w7_latest_topics": f"select {_G}, topic, topic_order from topic_pool qualify row_number() over (partition by {_G}, topic, {_V} order by is_latest desc nulls last, created_at desc nulls last, run_id desc nulls last, topic_order nulls last) = 1",
    "w9_latest_decision": _APPROVED + "select decision_id from a",
    "w11_cap": _LATEST + f"select detail_id from latest where {_OTHERS} qualify row_number() over (partition by {_GV} order by md5({_TEXT('memo_id')}), memo_id) <= 10",
    "a2_a3_group_counts": f"""with c as (select {_GV}, count(*) as total_cnt, {_IF("pred_topic_type = 'overall'")} as overall_cnt, {_IF(_OTHERS)} as others_cnt, {_IF('llm_used_yn')} as llm_used_cnt, {_IF('review_needed_yn')} as review_needed_cnt
        from classification_detail group by all) select *, overall_cnt / total_cnt as overall_ratio, others_cnt / total_cnt as others_ratio, llm_used_cnt / total_cnt as llm_used_ratio, review_needed_cnt / total_cnt as review_needed_ratio from c""",
    "a4_summary": f"""with t as (select {_GV}, pred_topic, pred_topic_type, count(*) as topic_cnt from classification_detail group by all),
        c as (select {_GV}, count(*) as total_cnt, {_IF("pred_topic_type = 'overall'")} as overall_cnt, {_IF(_OTHERS)} as others_cnt, {_IF('llm_used_yn')} as llm_used_cnt, {_IF('review_needed_yn')} as review_needed_cnt from classification_detail group by all)
        select t.*, c.total_cnt, c.overall_cnt, c.others_cnt, c.llm_used_cnt, c.review_needed_cnt, topic_cnt / total_cnt as topic_ratio from t join c on {_on('t', 'c', _GV)}""",
    "a5_others": f"""with c as (select {_GV}, count(*) as others_cnt, count(distinct memo_norm) as distinct_memo_norm_cnt, count(distinct memo_id) as distinct_memo_id_cnt, {_IF('llm_used_yn')} as llm_used_cnt, {_IF('review_needed_yn')} as review_needed_cnt
        from classification_detail where {_OTHERS} group by all) select *, llm_used_cnt / others_cnt as llm_used_ratio, review_needed_cnt / others_cnt as review_needed_ratio from c""",
    "a6_candidates": _CAND + f"select {_G}, memo_norm, candidate_cnt, sample_memo, others_cnt, candidate_ratio from k where candidate_cnt >= 2 and candidate_ratio >= 0.01",
    "a7_candidates_distinct": f"""with d as (select sc_measurement, memo_id, {_NORM} as memo_norm from classification_detail where {_OTHERS}),
        c as (select sc_measurement, memo_norm, count(*) as candidate_cnt, count(distinct memo_id) as distinct_memo_id_cnt from d where memo_norm <> '' group by all),
        r as (select *, candidate_cnt / sum(candidate_cnt) over (partition by sc_measurement) as candidate_ratio from c) select * from r where distinct_memo_id_cnt >= 2""",
    "a4_rounded": f"""with t as (select {_GV}, pred_topic, pred_topic_type, count(*) as n from classification_detail group by all), r as (select *, n / sum(n) over (partition by {_GV}) as x from t)
        select {_GV}, pred_topic, pred_topic_type, round(x, 4) as topic_ratio, round(x * 100, 2) as topic_pct from r""",
    "a22_counts": f"select count(*) as all_cnt, {_IF('review_needed_yn and ' + _OTHERS)} as filtered_cnt from classification_detail",
    "listing_filter": "select detail_id from classification_detail where sc_measurement = -1 and pred_topic_type = 'topic' and contains(lower(memo), 'the')",
    "o8_preview": "select detail_id from classification_detail order by md5(concat_ws('||', cast(detail_id as varchar), '42')), detail_id limit 30",
    "a10_overall": "select count(*) as row_cnt, count(distinct memo_id) as memo_cnt, count(*) filter (where embedding is null) as null_cnt, count(distinct len(embedding)) as dim_cnt from memo_embedding",
    "a10_sparse": f"select {_GV}, pred_topic, embedding_model, count(*) as row_cnt, count(distinct memo_id) as memo_cnt from memo_embedding group by all having count(distinct memo_id) < 3",
    "f7_term_list": f"""with d as (select {_G}, topic_order, {_CLEANED("string_split(description, ' ')")} as x from topic_pool) select {_G}, topic_order, array_to_string({_FIRST('x', 5)}, '|') as terms from d""",
    "f9_f13_terms": f"""with d0 as (select detail_id, memo, {_LOW('memo')} as low, {_PHRASE('memo')} as phrase, {_LONGEST(_LOWS("string_split(lower(pred_topic), ' ')"))} as terms from classification_detail where pred_topic is not null)
        select detail_id, {_ANY('low', 'terms')} as said, phrase, {_WITHOUT(_SPACED('phrase'), _PHRASES('terms'))} as rest, {_STRIPPED('low', 'terms')} as stripped, {_near('low', _TOKEN_LIST('memo'), 'terms[1:1]', 'terms[2:2]', 4, 20)} as near from d0""",
    "f15_json_list": f"select {_G}, topic_order, cast(len({_JSON('representative_memos_json')}) as integer) as memos from topic_pool",
    "c4_c5_overall": _RULED.replace("conn0 as (select null::varchar as w where false),", _CONNECTORS) + f" select {_G}, memo_id, rule from ru",
    "c7_candidates": _RAW.rstrip() + f""",{_TOPICS},{_PROFILE}, me as (select one.*, {_LOW('memo')} as low, overall_topic_name, list_transform(feature, lambda t: lower(t)) as features from one join prof using ({_G})),{_scores('me', 'm.features', 'm.overall_topic_name')}
        select {_G}, memo_id, cast(place - 1 as integer) as place, topic, score from sc""",
    "c8_c11_classify": _CLASSIFIED + " select * from cl",
    "c11_counts": _CLASSIFIED + " select pred_topic_type, classification_stage, count(*) as row_cnt from cl group by all",
    "l4_model_fallback": _CLASSIFIED + f""", nm as (select {_G}, list_sort(list(topic)) as names from top group by all),
        q as (select cl.*, coalesce(names, []::varchar[]) as names, pred_topic_type in ('ambiguous', 'others') as ask from cl left join nm using ({_G})),
        an as (select *, list_sort(list_transform(names, lambda t: {{'n': -len(list_intersect(list_distinct(string_split(lower(memo), '')), list_distinct(string_split(lower(t), '')))), 't': t}})) as ranked, {_OVERALL} as overall_name from q),
        an1 as (select *, ranked[1].n as top_n, list_sort(list_transform(list_filter(ranked, lambda e: e.n = ranked[1].n), lambda e: e.t)) as equal from an),
        an2 as (select *, case when ask then equal[-1] end as said from an1)
        select {_G}, memo_id, memo, case when not ask then pred_topic when said is null then '기타' else said end as pred_topic,
          case when not ask then pred_topic_type when said is null or said = '기타' then 'others' when said = overall_name then 'overall' else 'topic' end as pred_topic_type,
          case when ask then 'llm_fallback' else classification_stage end as classification_stage, case when ask then null else confidence_score end as confidence_score,
          case when ask then said is null or said = '기타' else review_needed_yn end as review_needed_yn, case when not ask then match_reason when said is null then 'no candidate' else 'closest name ' || said end as match_reason,
          candidate_topics_json, ask or llm_used_yn as llm_used_yn from an2""",
    "c9_rescue": f"""with {_TOPICS.strip()}, nm as (select {_G}, list_filter(list_sort(list(topic)), lambda t: t <> '기타') as names from top group by all),
        d as (select c.*, {_NAMED('match_reason', "coalesce(names, []::varchar[])")} as named from classification_detail c left join nm using ({_G}) where classification_stage = 'llm_fallback'),
        h as (select *, pred_topic_type = 'others' and named is not null as hit from d)
        select detail_id, case when hit then named else pred_topic end as pred_topic, case when hit then 'topic' else pred_topic_type end as pred_topic_type, case when hit then 'llm_reason_recovered' else classification_stage end as classification_stage,
          case when hit then false else review_needed_yn end as review_needed_yn, case when hit then concat_ws(' | ', match_reason, 'recovered_from_reason') else match_reason end as match_reason from h""",
    "c10_normalized": f"""select detail_id, case when trim(coalesce(pred_topic, ''), ' ') = '' then '기타' else pred_topic end as pred_topic,
        case when trim(coalesce(pred_topic, ''), ' ') = '' or trim(coalesce(pred_topic_type, ''), ' ') = '' then 'others' else pred_topic_type end as pred_topic_type,
        case when trim(coalesce(classification_stage, ''), ' ') = '' then 'forced_others' else classification_stage end as classification_stage, {_SCORE} as confidence_score,
        coalesce(llm_used_yn, false) as llm_used_yn, coalesce(review_needed_yn, true) as review_needed_yn, coalesce(match_reason, '') as match_reason, 'v1' as prompt_version, 'run_1' as run_id, true as is_latest from classification_detail""",
    "c15_reassign": _REASSIGNED + " select * from ra where suggested_topic is not null",
    "r1_r2_decisions": _REASSIGNED + ", cd as (select " + f"""{_GV}, memo_norm, count(*) as n from classification_detail where {_OTHERS} and coalesce(memo_norm, '') <> '' group by all having count(*) >= 2)
        select sha256({_KEY("'reassign_existing_topic'", *map(_TEXT, [*_G.split(', '), 'memo_id', 'suggested_topic']))}) as decision_id, 'reassign_existing_topic' as candidate_type, {_G}, suggested_topic, 'pending' as decision_status from ra where suggested_topic is not null
        union all select sha256({_KEY("'create_new_topic'", *map(_TEXT, [*_G.split(', '), 'memo_norm', *_V.split(', ')]))}), 'create_new_topic', {_G}, null, 'pending' from cd""",
    "r3_edits": _APPROVED.rstrip() + f""", e as (select memo_id, approved_action, approved_topic from a where approved_action = 'keep_others' or trim(coalesce(approved_topic, ''), ' ') <> '' qualify row_number() over (partition by memo_id order by decision_id) = 1),
        l as (select * from classification_detail qualify row_number() over (partition by {_GV}, memo_id order by is_latest desc nulls last, created_at desc nulls last, run_id desc nulls last, detail_id) = 1)
        select sha256({_KEY(*map(_TEXT, [*_G.split(', '), 'memo_id', 'approved_action', 'approved_topic', *_V.split(', ')]))}) as decision_id, {_G}, memo_id, pred_topic as current_pred_topic, approved_action, approved_topic, 'approved' as decision_status from l join e using (memo_id)""",
    "r5_applied": _APPROVED.rstrip() + f""", j as (select d.cate_1_depth, d.cate_2_depth, d.sc_measurement, a.approved_action = 'reassign_existing_topic' and trim(coalesce(a.approved_topic, ''), ' ') <> '' as m, a.approved_action = 'keep_others' as k
        from classification_detail d left join a on {_on('d', 'a', _G + ', memo_id, ' + _V)}) select {_G}, count(*) as row_cnt, {_IF('m')} as reassigned_cnt, {_IF('k')} as kept_cnt from j group by all""",
    "r7_refinement": _REASSIGNED + f""", cd as (select {_GV}, memo_norm, count(*) as n from latest where {_OTHERS} and coalesce(memo_norm, '') <> '' group by all having count(*) >= 2)
        select 'candidates' as part, {_G}, count(*) as cnt from cd group by all union all select 'health', {_G}, count(*) from (select distinct {_GV} from latest) group by all
        union all select 'reassignments', {_G}, count(*) from ra where suggested_topic is not null group by all""",
    "r8_others": f"""with o as (select * from classification_detail where {_OTHERS}), c as (select {_GV}, memo_norm, count(*) as n from o where coalesce(memo_norm, '') <> '' group by all), r as (select *, n / sum(n) over (partition by {_GV}) as x from c)
        select 'summary' as part, {_G}, count(*) as cnt from (select distinct {_GV} from o) group by all union all select 'candidates', {_G}, count(*) from r where n >= 2 and x >= 0.01 group by all""",
    "r9_manual": f"""with d as (select {_G}, memo_id, approved_topic, reviewer, case when trim(coalesce(approved_topic, ''), ' ') <> '' then 'reassign_existing_topic' else 'keep_others' end as approved_action from review_decision where trim(coalesce(memo_id, ''), ' ') <> '')
        select sha256({_KEY(*map(_TEXT, [*_G.split(', '), 'memo_id', 'approved_action', 'approved_topic', 'reviewer']))}) as decision_id, memo_id, approved_action, approved_topic, 'approved' as decision_status from d""",
    "k8_decision_update": """with d as (select *, coalesce(decision_status = 'pending' and coalesce(suggested_topic, '') = '', false) as hit from review_decision)
        select decision_id, case when hit then 'rejected' else decision_status end as decision_status, case when hit then 'console' else reviewer end as reviewer, case when hit then '2026-01-01' else reviewed_at end as reviewed_at, approved_action from d""",
    "l5_seeds": _SAMPLED + f""" select {_G}, array_to_string(best[1:3], ' ') as category_summary, array_to_string(best, '|') as feature_hint_terms, array_to_string(best[1:5], '|') as candidate_topic_labels, {_SHOWN_TERMS(2, 12)} as sample_non_overall_memos from mm join bw using ({_G})""",
    "l6_profiles": _SAMPLED + f""" select {_G}, {_OVERALL} as overall_topic_name, array_to_string(best[1:2], '|') as overall_sentiment_terms, array_to_string(best, '|') as feature_hint_terms, best[-1] as reason_signal_terms, {_SHOWN_TERMS(3, 20)} as non_overall_examples from mm join bw using ({_G})""",
    "l7_pools": _SAMPLED + f""", tt as (select {_G}, k, word as topic, 'memos about ' || word as description, list_filter(memos, lambda m: contains(lower(m), word))[1:2] as shown_memos from be join mm using ({_G}) where lower(word) <> {_OVERALL}),
        u as (select {_G}, 0 as k, {_OVERALL} as topic, '' as description, []::varchar[] as shown_memos from bw union all select * from tt), v as (select *, row_number() over (partition by {_G} order by k) as o, count(*) over (partition by {_G}) as n from u)
        select {_G}, cast(case when n >= 7 then o end as integer) as topic_order, case when n >= 7 then topic end as topic, case when n >= 7 then description end as description, case when n >= 7 then array_to_string(shown_memos, '|') else '' end as memos, cast(case when n >= 7 then n else 0 end as integer) as topic_count, n < 7 as failed from v where n >= 7 or o = 1""",
    "l9_references": f"""with {_TOPICS.strip()} select {_G}, '[' || string_agg('{{"topic":' || to_json(topic) || ',"description":' || to_json(description) || ',"hints":' || to_json(hints[1:15]) || ',"memos":' || to_json(memos[1:3]) || '}}', ',' order by topic) || ']' as reference_json from top group by all""",
    "l9_examples": f"""with {_TOPICS.strip()},{_PROFILE},{_GROUPS}, e as (select {_G}, list_concat(flatten(list_transform(list_filter(neutral_terms, lambda t: length(t) >= 2)[1:6], lambda t: list_transform(sentiment[1:5], lambda s: s || ' ' || t))), sentiment[1:5]) as x from gt)
        select {_G}, array_to_string(list_filter(x, lambda t, i: list_position(x, t) = i)[1:20], '|') as examples from e""",
    "l10_mapping": f"""with t as (select {_G}, topic as source_topic, min(coalesce(description, '')) as told from topic_pool where {_CLEAN('topic')} <> '' group by all),
        p as (select {_G}, source_topic, {_CLEAN('source_topic')} as s, min({_CLEAN('told')}) as d from t group by all)
        select {_G}, source_topic, case when contains(source_topic, {_OVERALL}) then {_OVERALL} else string_split(source_topic, ' ')[1] end as merged_topic,
          case when contains(source_topic, {_OVERALL}) then '' else d end as merged_description, case when contains(source_topic, {_OVERALL}) then 'locked' else 'first word' end as merge_reason from p""",
    "o5_top_prototypes": _ROUTED.replace("prototype_topic nulls first) = 1\n)", "prototype_topic nulls first) <= 3\n)").replace("as prototype_route\n  from pairs where similarity is not null", "as prototype_route, row_number() over (partition by " + _GV + ", embedding_model, memo_id order by similarity desc, distinct_memo_cnt desc, prototype_topic nulls first) as k from pairs where similarity is not null") + f" select {_GV}, memo_id, cast(k as integer) as \"rank\", prototype_topic as topic, round(round(similarity, 6), 5) as similarity from routed",
    "o3_top_candidates": _CAND + f"select {_G}, memo_norm, candidate_cnt from k order by candidate_cnt desc, candidate_ratio desc, {', '.join(c + ' nulls first' for c in _G.split(', '))}, memo_norm limit 200",
    "a8_health": f"with c as (select {_GV}, count(*) as row_cnt, count(distinct memo_id) as distinct_memo_cnt, {_IF(_OTHERS)} as others_cnt from classification_detail group by all) select *, others_cnt / row_cnt as others_ratio from c",
    "a9_totals": f"""select count(*) as row_cnt, {_IF("pred_topic_type = 'overall'")} as overall_cnt, {_IF("pred_topic_type = 'topic'")} as topic_cnt, {_IF(_OTHERS)} as others_cnt, {_IF("pred_topic_type = 'ambiguous'")} as ambiguous_cnt, {_IF('llm_used_yn')} as llm_used_cnt, {_IF('review_needed_yn')} as review_needed_cnt from classification_detail""",
    "a16_topic_share": _SHARE + "select *, review_count / group_count as topic_share from share",
    "a17_topic_lines": f"select {_G}, string_agg(concat(topic_order, '. ', topic, ': ', coalesce(description, '')), chr(10) order by topic_order, topic, coalesce(description, '')) as topics_text from topic_pool group by all",
    "a18_rare_topics": f"select {_G}, pred_topic, count(*) as row_cnt from classification_detail where not coalesce(starts_with(pred_topic, 'Overall'), false) group by all having count(*) < 10",
    "j17_fold_rare": f"""with n as (select {_G}, pred_topic, count(*) as c from classification_detail group by all)
        select d.detail_id, case when n.c < 10 and not coalesce(starts_with(d.pred_topic, 'Overall'), false) then 'Other' else d.pred_topic end as final_topic from classification_detail d join n on {_on('d', 'n', _G + ', pred_topic')}""",
    "a19_w15_distribution": _LABELS + """, n as (select cate_1_label, cate_2_label, sc_measurement, pred_topic, count(*) as row_cnt, count(distinct memo_id) as memo_cnt from d group by all)
        select *, cast(sum(row_cnt) over () as bigint) as all_cnt, row_cnt / sum(row_cnt) over () as row_ratio from n""",
    "a20_reconciliation": _LATEST.replace("with n0", _RAW.strip() + ", n0", 1) + f""", det as (select * from latest qualify row_number() over (partition by {_G}, memo_id order by is_latest desc nulls last, created_at desc nulls last, run_id desc nulls last, detail_id nulls last) = 1),
        full_ as (select memos.memo_id from memos join det using ({_G}, memo_id))
        select *, full_rows / full_memos as rows_per_memo from (select count(*) as detail_rows, count(distinct memo_id) as detail_memos from det), (select count(*) as full_rows, count(distinct memo_id) as full_memos from full_)""",
    "a23_kpis": f"select count(*) as row_cnt, {_IF(_OTHERS)} as others_cnt, count(distinct memo_id) as memo_cnt, count(distinct pred_topic) as topic_cnt from classification_detail",
    "a23_top_topics": """with c as (select sc_measurement, pred_topic, count(*) as row_cnt from classification_detail where pred_topic is not null group by all)
        select *, cast(row_number() over (partition by sc_measurement order by row_cnt desc, pred_topic) as integer) as "rank" from c qualify "rank" <= 25""",
    "o6_review_list": _LATEST + f"""select detail_id, memo_norm from (select * from latest where review_needed_yn qualify row_number() over (partition by {_GV}, memo_id order by created_at desc nulls last, run_id desc nulls last, detail_id) = 1)
        order by memo_norm nulls first, detail_id limit 300""",
    "o7_pool_listing": """with m as (select cate_1_depth, cate_2_depth, min(cate_2_depth_kor) k2 from category_mapping group by all)
        select coalesce(k2, p.cate_2_depth) as cate_2_label, sc_measurement, topic_order, topic from topic_pool p left join m using (cate_1_depth, cate_2_depth)
        order by p.cate_1_depth nulls first, p.cate_2_depth nulls first, sc_measurement nulls first, topic_order nulls first, topic nulls first limit 500""",
    "a24_topic_options": f"select {_G}, array_to_string(list_sort(list(distinct topic)), '|') as topics from topic_pool group by all",
    "a25_repeats": f"select {_G}, memo_id, pred_topic, count(*) as row_cnt from classification_detail group by all order by row_cnt desc, {', '.join(c + ' nulls first' for c in _G.split(', '))}, memo_id nulls first, pred_topic nulls first limit 30",
    "a26_decisions": "select decision_status, approved_action, count(*) as cnt from review_decision group by all",
    "w14_group_total": f"with n as (select {_G}, pred_topic, count(*) as cnt from classification_detail group by all) select *, cast(sum(cnt) over (partition by {_G}) as bigint) as group_total from n",
    "j1_expand": _LATEST.replace("with n0", _RAW.strip() + ", n0", 1) + f""", det as (select * from latest qualify row_number() over (partition by {_G}, memo_id order by is_latest desc nulls last, created_at desc nulls last, run_id desc nulls last, detail_id nulls last) = 1)
        select memos.detail_id, det.pred_topic, det.pred_topic_type, case when isnan(det.confidence_score) then null else det.confidence_score end as confidence_score from memos join det using ({_G}, memo_id)""",
    "q10_unmatched": _LATEST.replace("with n0", _RAW.strip() + ", n0", 1) + f"select m.detail_id from memos m where not exists (select 1 from latest l where l.pred_topic_type = 'topic' and {' and '.join(f'm.{c} = l.{c}' for c in [*_G.split(', '), 'memo_id'])})",
    "j4_increment": f"select detail_id from classification_detail d where not exists (select 1 from memo_embedding e where e.embedding_model = 'stub-encoder-64' and {' and '.join(f'd.{c} = e.{c}' for c in [*_GV.split(', '), 'memo_id'])})",
    "j11_category_labels": _LABELS + "select detail_id, cate_1_label, cate_2_label from d",
    "j15_pool_share": _SHARE + f"""select p.cate_1_depth, p.cate_2_depth, p.sc_measurement, p.topic_order, p.topic, coalesce(s.review_count, 0) as review_count, coalesce(s.review_count / s.group_count, 0) as topic_share
        from topic_pool p left join share s on p.topic = s.pred_topic and {' and '.join(f'p.{c} = s.{c}' for c in _G.split(', '))}""",
    "j16_merged": f"""with m as (select {_G}, source_topic, min(merged_topic) as merged_topic from {_MAP} group by all)
        select d.detail_id, coalesce(m.merged_topic, d.pred_topic) as merged_topic from classification_detail d left join m on d.pred_topic = m.source_topic and {' and '.join(f'd.{c} = m.{c}' for c in _G.split(', '))}""",
    "u6_identity_mapping": f"""with m as (select * from {_MAP}) select * from m union all
        select distinct {_G}, pred_topic as source_topic, pred_topic as merged_topic from classification_detail d where pred_topic is not null and not exists (select 1 from m where d.pred_topic = m.source_topic and {' and '.join(f'd.{c} = m.{c}' for c in _G.split(', '))})""",
    "u3_distinct": f"select distinct {_GV} from classification_detail",
    "k3_replace_groups": f"""with n as (select detail_id, {_GV}, upper(pred_topic) as pred_topic from classification_detail where sc_measurement = 1 and pred_topic is not null)
        select detail_id, {_GV}, pred_topic from classification_detail d where not exists (select 1 from n where {_on('d', 'n', _GV)}) union all select * from n""",
    "k4_replace_ids": "select decision_id, case when decision_status = 'pending' then 'hold' else decision_status end as decision_status from review_decision",
    "k15_conform": f"select {_G}, pred_topic, count(*) as rows, cast(0 as bigint) as topic_cnts from classification_detail group by all",
    "a10_quality": f"select {_GV}, pred_topic, embedding_model, count(*) as row_cnt, count(distinct memo_id) as memo_cnt from memo_embedding group by all",
    "a10_repeats": f"select {_GV}, memo_id, embedding_model, count(*) as row_cnt from memo_embedding group by all having count(*) > 1",
    "e6_prototypes": _VECTORS + f"select {_GV}, pred_topic, embedding_model, memo_cnt, distinct_memo_cnt, round(avg_confidence, 6) as avg_confidence, cast(unnest(range(0, 64)) as integer) as pos, round(unnest(prototype), 6) as x from proto",
    "e7_nearest": _ROUTED + f"select {_GV}, memo_id, true_topic, prototype_topic, round(similarity, 6) as similarity, prototype_route from routed",
    "a13_e8_evaluation": _ROUTED + f"""select {_G}, count(*) as row_cnt, round(avg(cast(true_topic = prototype_topic as double)), 6) as accuracy, round(avg(similarity), 6) as avg_similarity,
        {_IF("prototype_route = 'auto_accept'")} as auto_accept_cnt, {_IF("prototype_route = 'llm_fallback'")} as llm_fallback_cnt, {_IF("prototype_route = 'review_required'")} as review_required_cnt from routed group by all""",
    "e8_confusion": _ROUTED + f"select {_G}, true_topic, prototype_topic, count(*) as row_cnt from routed group by all",
    "a14_e9_similarity": _VECTORS + f""", few as (
          select {_GV}, embedding_model, memo_id, pred_topic, list_transform(embedding, lambda e: cast(e as double) / nullif(sqrt(list_sum(list_transform(embedding, lambda y: cast(y as double) * cast(y as double)))), 0)) as u from v
          qualify row_number() over (partition by {_GV}, pred_topic, embedding_model order by md5(concat_ws('||', {_TEXT('memo_id')}, '42')), memo_id) <= 20
        ), pairs as (
          select a.cate_1_depth, a.cate_2_depth, a.sc_measurement, case when a.pred_topic = b.pred_topic then 'intra' else 'inter' end as pair_type, list_dot_product(a.u, b.u) as s
          from few a join few b using ({_GV}, embedding_model) where a.memo_id < b.memo_id and a.u[1] is not null and b.u[1] is not null
        ) select {_G}, pair_type, count(*) as pair_cnt, round(avg(s), 6) as avg_similarity, round(quantile_cont(s, 0.5), 6) as median_similarity from pairs group by all""",
    "e1_encode": _RAW.rstrip() + f""", w as (select memo_id, unnest({_TOKEN_LIST('memo')}) as w from one), h as (select memo_id, md5(w) as m from w),
        c as (select memo_id, cast(('0x' || substr(m, 1, 2)) as integer) % 64 as pos, sum(case when cast(('0x' || substr(m, 3, 2)) as integer) >= 128 then 1 else -1 end) as x from h group by all)
        select memo_id, 'hash-encoder-64' as embedding_model, cast(64 as integer) as embedding_dim, cast(pos as integer) as pos, round(x / sqrt(sum(x * x) over (partition by memo_id)), 4) as x from c where x <> 0""",
    "c7_overlap": _RAW + f""", p as (select distinct {_G}, topic from topic_pool)
        select {_G}, memo_id, topic, cast(len(list_intersect({_TOKENS('memo')}, {_TOKENS('topic')})) as integer) as overlap from one join p using ({_G}) where overlap > 0""",
    "r4_overlay": _APPROVED + f"""select d.detail_id,
          case when m then a.approved_topic when k then '기타' else d.pred_topic end as pred_topic, case when m then 'topic' when k then 'others' else d.pred_topic_type end as pred_topic_type,
          case when m then 'human_fallback_reassign' when k then 'human_fallback_keep_others' else d.classification_stage end as classification_stage,
          case when m or k then 1.0 when isnan(d.confidence_score) then null else d.confidence_score end as confidence_score, case when m or k then false else d.review_needed_yn end as review_needed_yn,
          case when m or k then concat_ws(' | ', a.approved_action, a.reviewer, d.match_reason) else d.match_reason end as match_reason
        from classification_detail d left join (select *, approved_action = 'reassign_existing_topic' and trim(coalesce(approved_topic, ''), ' ') <> '' as m, approved_action = 'keep_others' as k from a) a
          on {_on('d', 'a', _G + ', memo_id, ' + _V)}""",
    "r6_revisions": f"""with d as (select *, case when approved_action = 'create_new_topic' then 'add_topic' else 'revise_topic_pool' end as revision_type,
        case when trim(coalesce(approved_topic, ''), ' ') <> '' then approved_topic else memo_norm end as proposed_topic from review_decision where decision_status = 'approved' and approved_action in ('create_new_topic', 'revise_topic_pool'))
        select sha256({_KEY(*map(_TEXT, ['revision_type', *_G.split(', '), 'decision_id', 'proposed_topic', *_V.split(', ')]))}) as revision_id, decision_id as source_decision_id, revision_type, {_G}, proposed_topic,
          concat_ws(' ', 'from review:', coalesce(review_comment, '')) as proposed_description, case when sample_memo is null then '[]' else '[' || to_json(sample_memo) || ']' end as representative_memos_json, 'proposed' as revision_status from d""",
}
