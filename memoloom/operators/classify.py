"""Set-based classification: rules for overall sentiment, then scored topics, for all groups in one plan.

A memo meets one row of its group, which holds the group's terms and topics; what it scores is computed inside that
row. Nothing is exploded, grouped again or joined back, and memos are shuffled only where the groups' rows are too
many to be sent to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import REASON_SCORE, RULE_CONFIDENCE, RULE_STAGES, WEIGHTS, Classifying
from ..functions import text
from ..functions.identity import GROUP
from .dims import Dictionaries, group_terms, topic_lists, words
from .rows import first_by, to_groups

MEMO = (*GROUP, "memo_id", "memo")
SHORTLIST = "array<struct<topic:string,score:double>>"


def ruled(memos: DataFrame, terms: DataFrame, c: Classifying = Classifying(), d: Dictionaries = Dictionaries()) -> DataFrame:
    """Memos with the columns of their group and ``rule``: the stage of the overall rule that holds, blocks or
    doesn't apply.

    Pure: a short memo that names the category and a sentiment and says no more than connecting words. Else a
    short memo with a sentiment, unless a feature or a reason stands near what it is about.
    """
    ready = memos.withColumns({n: F.expr(x) for n, x in {"_low": text.low("memo"), "_words": text.token_list("memo"), "_spaced": text.spaced(text.phrase("memo")), "_length": f"length({text.clean('memo')})"}.items()})
    df = to_groups(ready, terms).withColumn("_connectors", words(d.connectors))
    short = f"_length <= {c.overall_max_text_length}"
    left = f"filter(split({text.without('_spaced', 'pure_phrases')}, ' '), t -> t <> '')"
    pure = f"_length > 0 and {short} and {text.has_any('_spaced', 'target_phrases')} and {text.has_any('_spaced', 'sentiment_phrases')} and forall({left}, t -> array_contains(_connectors, t))"
    attached = lambda what, gap: text.near("_low", "_words", "neutral_low", what, gap)
    blocked = f"{attached('features', 5)} or {text.has_any(text.stripped('_low', 'neutral_low'), 'features')} or {attached('reasons', 4)}"
    # The costly tests come last: only memos with a sentiment reach them
    rule = f"""case when {pure} then 'rule_overall_target_sentiment' when not {text.has_any('_low', 'said')} then 'rule_non_overall'
        when {blocked} then 'rule_overall_blocked' when {short} then 'rule_overall' else 'rule_non_overall' end"""
    return df.withColumn("rule", F.expr(rule))


def overall(memos: DataFrame, terms: DataFrame, c: Classifying = Classifying(), d: Dictionaries = Dictionaries()) -> DataFrame:
    """Memos with ``rule`` (:func:`ruled`) and what their profile says of the overall topic and of features."""
    return ruled(memos, terms, c, d).select(*memos.columns, "overall_topic_name", "feature_hint_terms", "rule")


def shortlist(c: Classifying = Classifying()) -> Column:
    """The memo's topics that score above 0, best first, ties by name; the overall one is left out.

    Needs ``_memo`` (tokens), ``_low`` (text), ``_said`` (feature terms in it), ``topics`` and ``overall_topic_name``.
    Score: 1.20 for each token in common with the name, 0.85 with the description, 0.05 with the representative memos;
    for each feature term in the memo 1.25 if the name has it, else 0.85 if the description has it; for each hint in
    the memo 2.0 if it has more than one word, else 1.4.
    """
    w = WEIGHTS
    common = lambda other: f"size(array_intersect(_memo, t.{other}))"
    features = f"aggregate(_said, 0D, (acc, f) -> acc + case when contains(t.low, f) then {w['feature_in_name']}D when contains(t.told_low, f) then {w['feature_in_description']}D else 0D end)"
    hinted = f"aggregate(filter(t.hints, h -> contains(_low, h)), 0D, (acc, h) -> acc + if(contains(h, ' '), {w['hint_of_words']}D, {w['hint']}D))"
    score = f"round({w['name']}D * {common('name')} + {w['description']}D * {common('told')} + {w['memos']}D * {common('shown')} + {features} + {hinted}, 4)"
    scored = f"filter(transform(topics, t -> struct(if(t.topic <=> overall_topic_name, 0D, -{score}) as order, t.topic as topic)), e -> e.order < 0)"
    return F.expr(f"transform(slice(sort_array({scored}), 1, {c.shortlist}), e -> struct(e.topic as topic, -e.order as score))")


def candidates(memos: DataFrame, topic: DataFrame, c: Classifying = Classifying()) -> DataFrame:
    """Group, memo_id and ``shortlist`` of each memo that scores for some topic of its group (:func:`shortlist`).

    ``memos`` needs ``feature_hint_terms`` and ``overall_topic_name``.
    """
    ready = to_groups(memos.withColumns({"_memo": F.expr(text.tokens("memo")), "_low": F.expr(text.low("memo"))}), topic_lists(topic))
    ready = ready.withColumn("_said", F.expr("filter(transform(feature_hint_terms, f -> lower(f)), f -> f <> '' and contains(_low, f))"))
    return ready.withColumn("shortlist", shortlist(c)).where(F.size("shortlist") > 0).select(*GROUP, "memo_id", "shortlist")


def decide(df: DataFrame, c: Classifying = Classifying()) -> DataFrame:
    """Resolves ``rule`` and ``shortlist`` into topic, type, stage, confidence, reason and whether to review."""
    first, second = F.get("shortlist", F.lit(0)), F.get("shortlist", F.lit(1))
    s1 = first["score"]
    margin = F.round(s1 - F.coalesce(second["score"], F.lit(0.0)), 4)
    by_rule = F.col("rule").isin(*RULE_STAGES)
    none = F.col("shortlist").isNull() | (F.size("shortlist") == 0)
    won = (s1 >= c.min_score) & (margin >= c.min_margin)
    pick = lambda a, b, t, o: F.when(by_rule, a).when(none, b).when(won, t).otherwise(o)
    why = F.format_string("top_score=%.4f;margin=%.4f", s1, margin)
    return df.withColumns({
        "pred_topic": pick(F.col("overall_topic_name"), F.lit(c.others_label), first["topic"], F.lit(c.others_label)),
        "pred_topic_type": pick(F.lit("overall"), F.lit("others"), F.lit("topic"), F.lit("ambiguous")),
        "classification_stage": pick(F.col("rule"), F.lit("forced_others"), F.lit("heuristic_topic_match"), F.lit("ambiguous_candidate_match")),
        "confidence_score": pick(F.lit(RULE_CONFIDENCE), F.lit(0.0), s1, s1),
        "review_needed_yn": pick(F.lit(False), F.lit(c.review_default), F.lit(False), F.lit(True)),
        "match_reason": pick(F.when(F.col("rule") == "rule_overall", "pure_sentiment_short_memo").otherwise("pure_category_target_sentiment"), F.lit("no_topic_candidate"), why, why),
        "candidate_topics_json": F.to_json(F.coalesce("shortlist", F.array().cast(SHORTLIST))),
        "llm_used_yn": F.lit(False),
    })


def classify(memos: DataFrame, profile: DataFrame, topic: DataFrame, c: Classifying = Classifying(), d: Dictionaries = Dictionaries()) -> DataFrame:
    """Labels of memos, one row a (group, memo_id); all groups at once. Groups without a profile give none.

    The rules come first, once; only memos that they leave open are scored.
    """
    df = ruled(memos.select(*MEMO), group_terms(profile, topic, d), c, d)
    open_ = ~F.col("rule").isin(*RULE_STAGES)
    df = df.withColumn("_memo", F.when(open_, F.expr(text.tokens("memo")))).withColumn("_said", F.when(open_, F.expr("filter(features, f -> contains(_low, f))")))
    df = df.withColumn("shortlist", F.when(open_, shortlist(c)))
    made = ("pred_topic", "pred_topic_type", "classification_stage", "confidence_score", "review_needed_yn", "match_reason", "candidate_topics_json", "llm_used_yn")
    return decide(df, c).select(*MEMO, *made)


def normalized(df: DataFrame, settings, versions: dict[str, str], at: str, c: Classifying = Classifying()) -> DataFrame:
    """Results as they are stored: a missing topic or type is that of the others, candidates are a list of at most
    ``c.shortlist``, flags are set, a NaN score is null; with the columns of run and versions."""
    blank = lambda x: F.trim(F.coalesce(F.col(x), F.lit(""))) == ""
    known = F.from_json("candidate_topics_json", SHORTLIST)
    return df.withColumns({
        "pred_topic_type": F.when(blank("pred_topic") | blank("pred_topic_type"), "others").otherwise(F.col("pred_topic_type")),
        "pred_topic": F.when(blank("pred_topic"), c.others_label).otherwise(F.col("pred_topic")),
        "classification_stage": F.when(blank("classification_stage"), "forced_others").otherwise(F.col("classification_stage")),
        "confidence_score": F.nanvl("confidence_score", F.lit(None).cast("double")),
        "candidate_topics_json": F.to_json(F.slice(F.coalesce(known, F.array().cast(SHORTLIST)), 1, c.shortlist)),
        "match_reason": F.coalesce("match_reason", F.lit("")),
        "llm_used_yn": F.coalesce("llm_used_yn", F.lit(False)),
        "review_needed_yn": F.coalesce("review_needed_yn", F.lit(c.review_default)),
        **{v: F.lit(x) for v, x in versions.items()},
        "run_id": F.lit(settings.run_id), "run_date": F.lit(settings.run_date), "pipeline_stage": F.lit("classification"), "is_latest": F.lit(True), "created_at": F.lit(at), "created_by": F.lit("pipeline"),
    })


def named_once(reason: Column, topics: Column, others: str | None = None) -> Column:
    """The topic that a reason names, if it names exactly one; ``others`` doesn't count."""
    known = topics if others is None else F.filter(topics, lambda t: t != others)
    hits = F.filter(known, lambda t: (t != "") & F.contains(F.coalesce(reason, F.lit("")), t))
    return F.when(F.size(hits) == 1, F.element_at(hits, 1))


def topic_names(topic: DataFrame) -> DataFrame:
    return topic.groupBy(*GROUP).agg(F.sort_array(F.collect_set("topic")).alias("_topics"))


def rescue(df: DataFrame, topic: DataFrame, c: Classifying = Classifying()) -> DataFrame:
    """Rows that a model put to others although its reason names exactly one topic take that topic."""
    out = to_groups(df, topic_names(topic), "left")
    found = named_once(F.col("match_reason"), F.coalesce("_topics", F.array().cast("array<string>")), c.others_label)
    hit = (F.col("classification_stage") == "llm_fallback") & (F.col("pred_topic_type") == "others") & found.isNotNull()
    new = {
        "pred_topic": F.when(hit, found).otherwise(F.col("pred_topic")),
        "pred_topic_type": F.when(hit, "topic").otherwise(F.col("pred_topic_type")),
        "classification_stage": F.when(hit, "llm_reason_recovered").otherwise(F.col("classification_stage")),
        "review_needed_yn": F.when(hit, False).otherwise(F.col("review_needed_yn")),
        "match_reason": F.when(hit, F.concat_ws(" | ", "match_reason", F.lit("recovered_from_reason"))).otherwise(F.col("match_reason")),
    }
    return out.select(*[new.get(c_, F.col(c_)).alias(c_) for c_ in df.columns])


def reassignments(others: DataFrame, topic: DataFrame, min_score: float = 0.8, min_margin: float = 0.0, c: Classifying = Classifying()) -> DataFrame:
    """Topics proposed for memos without one: that which the reason names once, else the best by score.

    Of repeated memos of a group the row of the smallest memo, reason, normal form and topic counts.
    """
    keep = ("memo", "match_reason", "memo_norm", "pred_topic")
    rows = first_by(others.where(F.col("pred_topic_type") == "others").select(*GROUP, "memo_id", *keep, "pred_topic_type"), [*GROUP, "memo_id"], [F.asc_nulls_last(x) for x in keep])
    rows = to_groups(rows, topic_lists(topic)).withColumns({"_memo": F.expr(text.tokens("memo")), "_low": F.expr(text.low("memo")), "_said": F.array().cast("array<string>"), "overall_topic_name": F.lit("")})
    out = rows.withColumn("_named", named_once(F.col("match_reason"), F.transform("topics", lambda t: t["topic"]))).withColumn("shortlist", shortlist(c))
    first, second = F.get("shortlist", F.lit(0)), F.get("shortlist", F.lit(1))
    margin = first["score"] - F.coalesce(second["score"], F.lit(0.0))
    ok = (first["score"] >= min_score) & (margin >= min_margin)
    out = out.withColumn("suggested_topic", F.coalesce("_named", F.when(ok, first["topic"]))).withColumn("suggestion_score", F.when(F.col("_named").isNotNull(), REASON_SCORE).when(ok, first["score"]))
    return out.where("suggested_topic is not null").select(*GROUP, "memo_id", "memo_norm", F.col("memo").alias("sample_memo"), F.col("pred_topic").alias("current_pred_topic"), F.col("pred_topic_type").alias("current_pred_topic_type"), "suggested_topic", "suggestion_score")


def counts(df: DataFrame) -> DataFrame:
    """Rows of each type and stage."""
    return df.groupBy("pred_topic_type", "classification_stage").agg(F.count(F.lit(1)).alias("row_cnt"))
