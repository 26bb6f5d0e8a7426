"""Queries of the core operators over the driver's tables, named by their place in the operator inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..boundary import HashEncoder, RuleModel, TermModel, category_seeds, design_pools, design_profiles, encode, merge_proposals, model_fallback, overall_examples, reference_topics
from ..config import Settings
from ..functions import text
from ..functions.identity import GROUP, VERSION, memo_id, normalize_memo, sampling_key, surrogate_key, with_memo_id
from ..operators import classify as cl
from ..operators import dims, joins, report, review, rows, sampling
from ..operators import vectors as vec
from ..schemas import TABLES, conform, schema
from ..sources.registry import Registry, eligible
from ..sources.store import replaced
from . import pipeline

SEED, CLASSIFY_SEED = "seed_20260420", "seed_20260707"
GV = [*GROUP, *VERSION]
NAMES = ("classification_detail", "memo_embedding", "review_decision", "topic_pool", "category_mapping")


class Tables:
    """The driver's tables by logical key."""

    def __init__(self, spark: SparkSession, folder: str):
        self.r = Registry.of_folder(spark, folder, NAMES)
        self.spark = spark

    @property
    def detail(self) -> DataFrame:
        return self.r.read("classification_detail")

    @property
    def raw(self) -> DataFrame:
        """Reviews as they came: without identity or labels."""
        return self.detail.select("detail_id", *GROUP, "year", "country", "brand_name", "device_type", "memo")

    @property
    def memos(self) -> DataFrame:
        """Regular reviews with the identity of their content."""
        return with_memo_id(eligible(self.raw))

    @property
    def identified(self) -> DataFrame:
        """Labels under the identity of their content, whatever normaliser they were written with."""
        return self.detail.withColumn("memo_norm", normalize_memo("memo")).withColumn("memo_id", memo_id("memo_norm"))

    @property
    def latest(self) -> DataFrame:
        """The newest label of each memo, by content, group and version."""
        return rows.latest(self.identified, [*GV, "memo_id"], ["is_latest", "created_at", "run_id"], ["detail_id"])

    @property
    def latest_in_group(self) -> DataFrame:
        """The newest label of each memo by content and group, of any version: one window, since the newest of the
        newest of each version is the newest of all."""
        return rows.latest(self.identified, [*GROUP, "memo_id"], ["is_latest", "created_at", "run_id"], ["detail_id"])

    @property
    def profile(self) -> DataFrame:
        """Rule profiles of the groups, which the pool repeats by topic."""
        p = self.r.read("topic_pool")
        one = rows.first_by(p, GROUP, [F.desc_nulls_last("created_at"), F.asc("topic_order"), F.asc("topic")])
        lists = [F.col(f"rule_profile_{c}").alias(c) for c in ("overall_sentiment_terms_json", "feature_hint_terms_json", "reason_signal_terms_json")]
        return one.select(*GROUP, "overall_topic_name", *lists)

    @property
    def pool(self) -> DataFrame:
        return self.r.read("topic_pool")

    @property
    def vectors(self) -> DataFrame:
        """Usable vectors, one a memo, group, version and model."""
        v = vec.embeddings(self.r.read("memo_embedding"), "stub-encoder-64", 64)
        return rows.first_by(v, [*GV, "memo_id", "embedding_model"], [F.desc_nulls_last("created_at"), F.desc_nulls_last("run_id"), F.asc_nulls_last("pred_topic")])


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Scans, predicates, identity


@query
def s1_scan(t):
    return t.r.scan("classification_detail", {"cate_1_depth": "01. Picture", "sc_measurement": 1}).select("detail_id", "memo_id", "pred_topic")


@query
def s2_eligible(t):
    return eligible(t.raw).select("detail_id", *GROUP)


@query
def s6_source_filter(t):
    return t.r.scan("classification_detail", snippets=("year >= '2023'", "device_type is not null")).select("detail_id", "year", "device_type")


@query
def f1_memo_norm(t):
    return t.raw.select("detail_id", normalize_memo("memo").alias("memo_norm"))


@query
def f3_memo_id(t):
    return t.memos.select("detail_id", "memo_id")


@query
def f4_decision_key(t):
    return t.r.read("review_decision").select("decision_id", surrogate_key("candidate_type", *GROUP, "memo_id", "suggested_topic", *VERSION).alias("surrogate"))


@query
def f5_sampling_key(t):
    return t.detail.select("detail_id", sampling_key("memo_id", *GROUP, F.lit(SEED)).alias("sampling_key"))


@query
def f6_clean_text(t):
    return t.r.read("topic_pool").select(*GROUP, "topic_order", F.expr(text.clean("description")).alias("description"))


@query
def f8_token_count(t):
    return t.raw.select("detail_id", F.size(F.expr(text.tokens("memo"))).alias("tokens"))


@query
def f14_label_tokens(t):
    return t.r.read("category_mapping").select("cate_1_depth", "cate_2_depth", F.array_join(F.expr(text.label_tokens("cate_2_depth")), "/").alias("tokens"))


@query
def f15_json_list(t):
    return t.pool.select(*GROUP, "topic_order", F.size(F.expr(text.json_list("representative_memos_json"))).alias("memos"))


@query
def f7_term_list(t):
    return t.pool.select(*GROUP, "topic_order", F.array_join(F.expr(text.term_list("split(description, ' ')", 5)), "|").alias("terms"))


@query
def f9_f13_terms(t):
    """A memo against the words of its topic: substring, phrase, phrases and words taken out, nearness."""
    d = t.detail.where("pred_topic is not null").select("detail_id", "memo", F.split(F.lower("pred_topic"), " ").alias("_t"))
    d = d.withColumns({"_low": F.expr(text.low("memo")), "_terms": F.expr(text.by_length(text.low_terms("_t"))), "_p": F.expr(text.phrase("memo"))})
    return d.select(
        "detail_id",
        F.expr(text.has_any("_low", "_terms")).alias("said"),
        F.col("_p").alias("phrase"),
        F.expr(text.without(text.spaced("_p"), text.phrases("_terms"))).alias("rest"),
        F.expr(text.stripped("_low", "_terms")).alias("stripped"),
        F.expr(text.near("_low", text.token_list("memo"), "slice(_terms, 1, 1)", "slice(_terms, 2, 1)", 4, 20)).alias("near"),
    )


@query
def f19_stratum(t):
    return sampling.with_stratum(t.memos).groupBy(*GROUP, "stratum").agg(F.count(F.lit(1)).alias("row_cnt"))


@query
def trusted_labels(t):
    return vec.trusted(t.detail).select("detail_id", "pred_topic")


# Sampling


@query
def w1_dedupe(t):
    return sampling.dedupe_for_sampling(t.memos, "detail_id").select("memo_id", "detail_id")


@query
def w2_dedupe(t):
    return sampling.dedupe_for_classification(t.memos, "detail_id").select("memo_id", "detail_id")


@query
def a1_groups(t):
    return sampling.target_groups(t.memos, 20)


@query
def w3_group_sample(t):
    return sampling.group_sample(sampling.dedupe_for_classification(t.memos, "detail_id"), 1000, SEED, "rn").select(*GROUP, "memo_id", "rn")


@query
def w4_w5_diverse_sample(t):
    return sampling.diverse_sample(sampling.dedupe_for_classification(t.memos, "detail_id"), 200, 800, SEED).select(*GROUP, "memo_id", "prompt_rn")


@query
def o1_hash_sample(t):
    return sampling.hash_order_sample(sampling.dedupe_for_classification(t.memos, "detail_id"), 1000, CLASSIFY_SEED).select(*GROUP, "memo_id")


@query
def w6_latest(t):
    return t.latest.select("memo_id", "detail_id")


@query
def w7_latest_topics(t):
    return rows.latest(t.pool, [*GROUP, "topic", *VERSION], ["is_latest", "created_at", "run_id"], ["topic_order"]).select(*GROUP, "topic", "topic_order")


@query
def w9_latest_decision(t):
    return review.approved(t.r.read("review_decision")).select("decision_id")


@query
def w11_cap(t):
    return rows.first_by(t.latest.where("pred_topic_type = 'others'"), GV, [sampling_key("memo_id"), F.asc("memo_id")], 10).select("detail_id")


# Reports


@query
def a2_a3_group_counts(t):
    return report.group_counts(t.detail)


@query
def a4_summary(t):
    return report.summary(t.detail)


@query
def a4_rounded(t):
    return report.rounded(report.summary(t.detail)).select(*GV, "pred_topic", "pred_topic_type", "topic_ratio", "topic_pct")


@query
def a22_counts(t):
    return rows.counted(t.detail, F.col("review_needed_yn") & (F.col("pred_topic_type") == "others"))


@query
def listing_filter(t):
    return rows.matching(t.detail, {"sc_measurement": -1, "pred_topic_type": "topic", "run_id": None}, {"memo": "The", "pred_topic": " "}).select("detail_id")


@query
def o8_preview(t):
    return sampling.preview(t.detail, 30, "42", "detail_id").select("detail_id")


@query
def a5_others(t):
    return report.others_summary(t.detail)


@query
def a6_candidates(t):
    c = report.new_topic_candidates(t.detail, 2, 0.01, keys=GROUP)
    return c.select(*GROUP, "memo_norm", "candidate_cnt", "sample_memo", "others_cnt", "candidate_ratio")


@query
def a7_candidates_distinct(t):
    """Over labels as they were written, whose ids come from several normalisers, so that a text has several."""
    c = report.new_topic_candidates(t.detail.withColumn("memo_norm", normalize_memo("memo")), 1, 0.0, 2, ("sc_measurement",))
    return c.select("sc_measurement", "memo_norm", "candidate_cnt", "distinct_memo_id_cnt", "candidate_ratio")


@query
def o3_top_candidates(t):
    return report.top(report.new_topic_candidates(t.detail, 1, 0.0, keys=GROUP), 200, F.desc("candidate_cnt"), F.desc("candidate_ratio"), *[F.asc_nulls_first(c) for c in (*GROUP, "memo_norm")]).select(*GROUP, "memo_norm", "candidate_cnt")


@query
def a8_health(t):
    return report.group_health(t.detail)


@query
def a9_totals(t):
    return report.totals(t.detail)


@query
def a16_topic_share(t):
    return report.topic_share(t.detail)


@query
def a17_topic_lines(t):
    return report.topic_lines(t.pool)


@query
def a18_rare_topics(t):
    return report.rare_topics(t.detail, 10, F.col("pred_topic").startswith("Overall"))


@query
def j17_fold_rare(t):
    return report.fold_rare(t.detail, 10, "Other", F.col("pred_topic").startswith("Overall")).select("detail_id", "final_topic")


@query
def a19_w15_distribution(t):
    d = joins.with_category_labels(t.detail, t.r.read("category_mapping"))
    return report.share_of_all(d, ("cate_1_label", "cate_2_label", "sc_measurement", "pred_topic"))


@query
def a24_topic_options(t):
    return report.topic_options(t.pool).select(*GROUP, F.array_join("topics", "|").alias("topics"))


@query
def a25_repeats(t):
    return report.repeats(t.detail, 30)


@query
def a26_decisions(t):
    return report.by(t.r.read("review_decision"), "decision_status", "approved_action")


@query
def w14_group_total(t):
    n = t.detail.groupBy(*GROUP, "pred_topic").agg(F.count(F.lit(1)).alias("cnt"))
    return rows.total_over(n, GROUP, "cnt", "group_total")


@query
def a20_reconciliation(t):
    detail = t.latest_in_group
    return report.reconciliation(detail, joins.expand(t.memos, detail))


@query
def a23_kpis(t):
    return report.kpis(t.detail)


@query
def a23_top_topics(t):
    return report.top_topics(t.detail, 25)


@query
def o7_pool_listing(t):
    p = joins.with_category_labels(t.pool, t.r.read("category_mapping"))
    return report.top(p, 500, *[F.asc_nulls_first(c) for c in (*GROUP, "topic_order", "topic")]).select("cate_2_label", "sc_measurement", "topic_order", "topic")


@query
def o6_review_list(t):
    d = rows.latest(t.latest.where("review_needed_yn"), [*GV, "memo_id"], ["created_at", "run_id"], ["detail_id"])
    return report.top(d, 300, F.asc_nulls_first("memo_norm"), F.asc("detail_id")).select("detail_id", "memo_norm")


# Joins and set operations


@query
def j1_expand(t):
    detail = t.latest_in_group
    return joins.expand(t.memos, detail).select("detail_id", "pred_topic", "pred_topic_type", "confidence_score")


@query
def q10_unmatched(t):
    detail = t.latest.where("pred_topic_type = 'topic'")
    return joins.unmatched(t.memos, detail.select(*GROUP, "memo_id").distinct()).select("detail_id")


@query
def j4_increment(t):
    d = t.detail.withColumn("embedding_model", F.lit("stub-encoder-64"))
    return rows.increment(d, t.r.read("memo_embedding"), [*GV, "memo_id", "embedding_model"]).select("detail_id")


@query
def j11_category_labels(t):
    return joins.with_category_labels(t.detail, t.r.read("category_mapping")).select("detail_id", "cate_1_label", "cate_2_label")


@query
def j15_pool_share(t):
    return joins.pool_with_share(t.pool, report.topic_share(t.detail)).select(*GROUP, "topic_order", "topic", "review_count", "topic_share")


def _mapping(t):
    """Topics of a group merged by their first word, as an example of a mapping."""
    m = t.pool.select(*GROUP, F.col("topic").alias("source_topic"), F.element_at(F.split("topic", " "), 1).alias("merged_topic")).distinct()
    return m.where("source_topic like '% %'")


@query
def j16_merged(t):
    return joins.merged_topics(t.detail, _mapping(t)).select("detail_id", "merged_topic")


@query
def u6_identity_mapping(t):
    return joins.identity_mapping(t.detail, _mapping(t))


@query
def u3_distinct(t):
    return t.detail.select(*GV).distinct()


@query
def k3_replace_groups(t):
    d = t.detail.select("detail_id", *GV, "pred_topic")
    new = d.where("sc_measurement = 1 and pred_topic is not null").withColumn("pred_topic", F.upper("pred_topic"))
    return replaced(d, new, tuple(GV))


@query
def k4_replace_ids(t):
    d = t.r.read("review_decision").select("decision_id", "decision_status")
    return replaced(d, d.where("decision_status = 'pending'").withColumn("decision_status", F.lit("hold")), ("decision_id",))


@query
def k8_decision_update(t):
    d = t.r.read("review_decision")
    out = review.updated(d, (F.col("decision_status") == "pending") & (F.coalesce("suggested_topic", F.lit("")) == ""), "rejected", "2026-01-01", reviewer="console")
    return out.select("decision_id", "decision_status", "reviewer", "reviewed_at", "approved_action")


@query
def k15_conform(t):
    return conform(t.detail, schema("classification_summary")).groupBy(*GROUP, "pred_topic").agg(F.count(F.lit(1)).alias("rows"), F.count("topic_cnt").alias("topic_cnts"))


# Vectors


@query
def a10_quality(t):
    return vec.quality(t.r.read("memo_embedding"))["topics"]


@query
def a10_repeats(t):
    return vec.quality(t.r.read("memo_embedding"))["repeats"]


@query
def a10_overall(t):
    return vec.quality(t.r.read("memo_embedding"))["overall"]


@query
def a10_sparse(t):
    return vec.quality(t.r.read("memo_embedding"))["sparse"]


@query
def e6_prototypes(t):
    """Every element of every prototype, one row each."""
    p = vec.prototypes(t.vectors).select(*vec.TOPIC, "memo_cnt", "distinct_memo_cnt", F.round("avg_confidence", 6).alias("avg_confidence"), F.posexplode("prototype").alias("pos", "x"))
    return p.withColumn("x", F.round("x", 6))


def _routed(t):
    return vec.nearest(t.vectors, vec.prototypes(t.vectors), 0.82, 0.70, 3)


@query
def e7_nearest(t):
    return _routed(t).select(*GV, "memo_id", "true_topic", "prototype_topic", F.round("similarity", 6).alias("similarity"), "prototype_route")


@query
def o5_top_prototypes(t):
    best = F.from_json("top_json", "array<struct<rank:int,topic:string,similarity:double>>")
    return _routed(t).select(*GV, "memo_id", F.inline(best)).select(*GV, "memo_id", "rank", "topic", F.round("similarity", 5).alias("similarity"))


@query
def a13_e8_evaluation(t):
    e = vec.evaluate(_routed(t), GROUP)
    return e.withColumn("accuracy", F.round("accuracy", 6)).withColumn("avg_similarity", F.round("avg_similarity", 6))


@query
def e8_confusion(t):
    return vec.confusion(_routed(t)).drop("avg_similarity")


@query
def a14_e9_similarity(t):
    s = vec.topic_similarity(t.vectors)
    return s.select(*GROUP, "pair_type", "pair_cnt", F.round("avg_similarity", 6).alias("avg_similarity"), F.round("median_similarity", 6).alias("median_similarity"))


@query
def e1_encode(t):
    d = sampling.dedupe_for_classification(t.memos, "detail_id").select(*GROUP, "memo_id", "memo")
    e = encode(d, HashEncoder()).select("memo_id", "embedding_model", "embedding_dim", F.posexplode("embedding").alias("pos", "x"))
    return e.where("x <> 0").withColumn("x", F.round(F.col("x").cast("double"), 4))


def _samples(t):
    m = sampling.dedupe_for_sampling(t.memos, "detail_id")
    large = m.join(sampling.target_groups(m, 20).select(*GROUP), list(GROUP), "left_semi")
    return sampling.diverse_sample(large, 200, 800, SEED).select(*GROUP, "memo", "prompt_rn")


@query
def l5_seeds(t):
    seeds = category_seeds(_samples(t), TermModel())
    return seeds.select(*GROUP, "category_summary", *[F.array_join(F.expr(text.json_list(c)), "|").alias(c[:-5]) for c in ("feature_hint_terms_json", "candidate_topic_labels_json", "sample_non_overall_memos_json")])


@query
def l6_profiles(t):
    p = design_profiles(_samples(t), TermModel())
    return p.select(*GROUP, "overall_topic_name", *[F.array_join(F.expr(text.json_list(f"{c}_json")), "|").alias(c) for c in ("overall_sentiment_terms", "feature_hint_terms", "reason_signal_terms", "non_overall_examples")])


@query
def l7_pools(t):
    p = design_pools(_samples(t), TermModel())
    return p.select(*GROUP, "topic_order", "topic", "description", F.array_join(F.expr(text.json_list("representative_memos_json")), "|").alias("memos"), "topic_count", F.col("error").isNotNull().alias("failed"))


@query
def l9_references(t):
    return reference_topics(dims.topics(t.pool))


@query
def l9_examples(t):
    terms = dims.group_terms(dims.profiles(t.profile), dims.topics(t.pool))
    return overall_examples(terms).select(*GROUP, F.array_join("examples", "|").alias("examples"))


@query
def l10_mapping(t):
    target = dims.overall_name(F.col("sc_measurement"))
    return joins.complete_mapping(t.pool, merge_proposals(t.pool, TermModel()), F.contains("source_topic", target), target)


# Classification and review


def _classified(t):
    d = sampling.dedupe_for_classification(t.memos, "detail_id")
    return cl.classify(d, dims.profiles(t.profile), dims.topics(t.pool))


@query
def c4_c5_overall(t):
    d = sampling.dedupe_for_classification(t.memos, "detail_id").select(*cl.MEMO)
    words = dims.Dictionaries(connectors=dims.frequent_words(eligible(t.raw)))
    terms = dims.group_terms(dims.profiles(t.profile), dims.topics(t.pool, words), words)
    return cl.overall(d, terms, d=words).select(*GROUP, "memo_id", "rule")


@query
def c7_overlap(t):
    """Tokens of a memo in common with the names of its group's topics."""
    d = sampling.dedupe_for_classification(t.memos, "detail_id")
    p = t.pool.select(*GROUP, "topic", F.expr(text.tokens("topic")).alias("name")).dropDuplicates([*GROUP, "topic"])
    pairs = d.withColumn("words", F.expr(text.tokens("memo"))).join(p, list(GROUP))
    return pairs.withColumn("overlap", F.size(F.array_intersect("words", "name"))).where("overlap > 0").select(*GROUP, "memo_id", "topic", "overlap")


@query
def c7_candidates(t):
    d = sampling.dedupe_for_classification(t.memos, "detail_id").select(*cl.MEMO)
    d = d.join(dims.profiles(t.profile).select(*GROUP, "feature_hint_terms", "overall_topic_name"), list(GROUP))
    found = cl.candidates(d, dims.topics(t.pool))
    return found.select(*GROUP, "memo_id", F.posexplode("shortlist").alias("place", "c")).select(*GROUP, "memo_id", "place", "c.topic", "c.score")


@query
def c8_c11_classify(t):
    return _classified(t)


@query
def c11_counts(t):
    return cl.counts(_classified(t))


@query
def l4_model_fallback(t):
    topics = dims.topics(t.pool)
    return cl.rescue(model_fallback(_classified(t), topics, RuleModel()), topics)


@query
def c9_rescue(t):
    d = t.detail.where("classification_stage = 'llm_fallback'")
    return cl.rescue(d, dims.topics(t.pool)).select("detail_id", "pred_topic", "pred_topic_type", "classification_stage", "review_needed_yn", "match_reason")


@query
def c10_normalized(t):
    out = cl.normalized(t.detail, Settings(run_id="run_1", run_date="20260101"), {"prompt_version": "v1"}, "2026-01-01")
    return out.select("detail_id", "pred_topic", "pred_topic_type", "classification_stage", "confidence_score", "llm_used_yn", "review_needed_yn", "match_reason", "prompt_version", "run_id", "is_latest")


@query
def c15_reassign(t):
    return cl.reassignments(t.latest, dims.topics(t.pool))


@query
def r1_r2_decisions(t):
    a = review.from_reassignments(cl.reassignments(t.latest, dims.topics(t.pool)))
    b = review.from_candidates(report.new_topic_candidates(t.detail, 2, 0.0))
    return rows.union(a, b).select("decision_id", "candidate_type", *GROUP, "suggested_topic", "decision_status")


@query
def r3_edits(t):
    """Reviewers' rows, as which the approved decisions stand, over the latest labels."""
    edits = review.approved(t.r.read("review_decision")).where("approved_action = 'keep_others' or trim(coalesce(approved_topic, '')) <> ''")
    edits = rows.first_by(edits, ["memo_id"], [F.asc("decision_id")]).select("memo_id", "approved_action", "approved_topic", "reviewer", "review_comment")
    d = rows.latest(t.detail, [*GV, "memo_id"], ["is_latest", "created_at", "run_id"], ["detail_id"])
    return review.from_edits(d, edits, "2026-01-01").select("decision_id", *GROUP, "memo_id", "current_pred_topic", "approved_action", "approved_topic", "decision_status")


@query
def r4_overlay(t):
    return review.overlay(t.detail, t.r.read("review_decision")).select("detail_id", "pred_topic", "pred_topic_type", "classification_stage", "confidence_score", "review_needed_yn", "match_reason")


@query
def r5_applied(t):
    return review.applied_counts(t.detail, t.r.read("review_decision"))


@query
def r6_revisions(t):
    r = review.revisions(t.r.read("review_decision"))
    return r.select("revision_id", "source_decision_id", "revision_type", *GROUP, "proposed_topic", "proposed_description", "representative_memos_json", "revision_status")


@query
def r7_refinement(t):
    """How many rows each part of the report has, by group."""
    parts = pipeline.refinement_report(t.latest, t.pool, Settings().updated({"reporting": {"refine_min_count": 2, "refine_min_ratio": 0.0}}))
    return rows.union(*[report.by(df.withColumn("part", F.lit(name)), "part", *GROUP) for name, df in parts.items()])


@query
def r8_others(t):
    parts = pipeline.others_report(t.detail, Settings().updated({"reporting": {"others_min_count": 2}}))
    return rows.union(*[report.by(df.withColumn("part", F.lit(name)), "part", *GROUP) for name, df in parts.items()])


@query
def r9_manual(t):
    typed = t.r.read("review_decision").select(*GROUP, "memo_id", "approved_topic", "reviewer")
    return review.manual(typed, "2026-01-01").select("decision_id", "memo_id", "approved_action", "approved_topic", "decision_status")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, d, f=f: f(Tables(spark, d))) for name, f in QUERIES.items()}


__all__ = ["QUERIES", "TABLES", "Tables", "queries"]
