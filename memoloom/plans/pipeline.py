"""Runs over all groups: classify, store, expand and summarise; resumable by what is already stored."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..boundary import Encoder, TextModel, design_pools, design_profiles, encode, merge_proposals, model_fallback
from ..config import Settings
from ..functions.identity import GROUP, VERSION, with_memo_id
from ..operators import joins, report, review
from ..operators.classify import classify, normalized, reassignments, rescue
from ..operators.dims import overall_name, profiles, topics
from ..operators.rows import increment, latest
from ..operators.sampling import dedupe_for_classification, dedupe_for_sampling, diverse_sample, hash_order_sample, target_groups
from ..operators.vectors import trusted
from ..schemas import schema
from ..sources.registry import eligible
from ..sources.store import Store

KEY = (*GROUP, *VERSION)


def checkpoint_key(pipeline: str, versions: dict[str, str], filters: dict[str, str | int | None]) -> str:
    """What a run is resumed by: its name, versions and filters, ``*`` for those that aren't set."""
    return "||".join([pipeline, *[versions.get(v, "") for v in VERSION], *[str(filters[g]) if filters.get(g) is not None else "*" for g in GROUP]])


def done_groups(progress: DataFrame, key: str) -> DataFrame:
    """Groups of which the last step ended; steps on the way don't count."""
    return progress.where((F.col("checkpoint_key") == key) & (F.col("step") == "group_done") & (F.col("status") == "completed")).select(*GROUP).distinct()


def failures(progress: DataFrame, key: str) -> DataFrame:
    return progress.where((F.col("checkpoint_key") == key) & (F.col("step") == "group_failed")).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("failed_cnt"))


def open_groups(groups: DataFrame, progress: DataFrame | None, key: str, max_failed: int = 2) -> DataFrame:
    """Groups that are neither done nor given up on."""
    if progress is None:
        return groups
    tired = failures(progress, key).where(F.col("failed_cnt") >= max_failed)
    return increment(increment(groups, done_groups(progress, key), GROUP), tired, GROUP)


def log_groups(store: Store, groups: DataFrame, key: str, step: str, status: str, at: str, settings: Settings) -> None:
    """A line for each group, with its ``message`` if there is such a column."""
    message = F.col("message") if "message" in groups.columns else F.lit("")
    rows = groups.select(*GROUP, message.alias("message")).withColumns({"checkpoint_key": F.lit(key), "pipeline_name": F.lit(key.split("||")[0]), "step": F.lit(step), "status": F.lit(status), "logged_at": F.lit(at), "run_id": F.lit(settings.run_id), "run_date": F.lit(settings.run_date)})
    store.write("pipeline_progress", rows, "append", schema=schema("pipeline_progress"))


def classify_all(store: Store, raw: DataFrame, profile: DataFrame, pool: DataFrame, settings: Settings, versions: dict[str, str], at: str, model: TextModel | None = None, min_size: int | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Classifies the open groups in one plan, replaces their rows in the store and logs them; returns them.

    Rows that a model could not answer make their group fail, with the cause in its log; its rows aren't stored and a
    later call takes it up again, until it has failed too often and counts as quarantined. Other groups don't notice.
    What stops the plan as a whole is raised and is no group's failure.
    """
    c = settings.classifying
    key = checkpoint_key("classification", versions, {})
    memos = dedupe_for_classification(with_memo_id(eligible(raw, settings.sampling.excluded_prefix, settings.sampling.sentiments, snippets=settings.source_filters)))
    sizes = memos.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("memo_cnt")).where(F.col("memo_cnt") >= (settings.sampling.min_group_size if min_size is None else min_size))
    groups = open_groups(sizes.select(*GROUP), store.read("pipeline_progress") if store.exists("pipeline_progress") else None, key, settings.max_failed_retries)
    some = hash_order_sample(memos.join(groups, list(GROUP), "left_semi"), c.max_rows_per_group, settings.sampling.classify_seed)
    dims = topics(pool)
    out = classify(some, profiles(profile), dims, c)
    if model is not None:
        out = rescue(model_fallback(out, dims, model, c, sleep), dims, c)
    meta = some.select(*GROUP, "memo_id", "memo_norm", "year", "country", "brand_name", "device_type")
    out = normalized(out.join(meta, [*GROUP, "memo_id"]), settings, versions, at, c)
    store.write("classification_staged", out, "overwrite")  # the model is asked once
    staged = store.read("classification_staged")
    bad = staged.where(F.col("classification_stage") == "llm_error").groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.min("match_reason").alias("cause"))
    good = staged.join(bad, list(GROUP), "left_anti")
    store.write("classification_detail", good, "replace", KEY, schema("classification_detail"))
    log_groups(store, bad.withColumn("message", F.concat(F.col("n").cast("string"), F.lit(" rows: "), "cause")), key, "group_failed", "failed", at, settings)
    log_groups(store, good.select(*GROUP).distinct(), key, "group_done", "completed", at, settings)
    return store.read("classification_detail").where(F.col("run_id") == settings.run_id)


def failure_causes(progress: DataFrame, key: str) -> DataFrame:
    """Failed groups and the number of failures by cause."""
    cause = F.regexp_replace("message", r"^\d+ rows: ", "").alias("cause")
    return progress.where((F.col("checkpoint_key") == key) & (F.col("step") == "group_failed")).groupBy(cause).agg(F.count(F.lit(1)).alias("failed_cnt"), F.count_distinct(*GROUP).alias("group_cnt"))


def apply_decisions(store: Store, settings: Settings, at: str, table: str = "classification_full") -> dict[str, int]:
    """Lays the approved decisions over a stored table, replaces the groups and versions that they touch, and counts."""
    old, decisions = store.read(table), store.read("review_decision")
    good = review.approved(decisions)
    touched = replaced_groups(old, good)
    new = review.overlay(touched, decisions).withColumns({"run_id": F.lit(settings.run_id), "run_date": F.lit(settings.run_date), "created_at": F.lit(at)})
    before = old.count()
    store.write(table, new, "replace", KEY, old.schema)
    now = store.read(table).where(F.col("run_id") == settings.run_id)
    n = now.agg(F.count_if(F.col("classification_stage") == "human_fallback_reassign").alias("a"), F.count_if(F.col("classification_stage") == "human_fallback_keep_others").alias("b")).first()
    return {"input_rows": before, "approved_decisions": good.count(), "output_rows": store.read(table).count(), "reassigned_rows": n["a"], "kept_others_rows": n["b"]}


def replaced_groups(df: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows of the groups and versions of which ``keyed`` has some, nulls being equal."""
    some = keyed.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(KEY)]).distinct()
    on = F.lit(True)
    for i, k in enumerate(KEY):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(some, on, "left_semi")


def others_report(detail: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """What is known of rows without a topic: by group, and memos that recur."""
    r = settings.reporting
    return {"summary": report.others_summary(detail), "candidates": report.new_topic_candidates(detail, r.others_min_count, r.others_min_ratio)}


def refinement_report(detail: DataFrame, pool: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """What a pool could be refined by: new topics, health of groups and reassignments. Nothing is stored."""
    r = settings.reporting
    return {
        "candidates": report.new_topic_candidates(detail, r.refine_min_count, r.refine_min_ratio, r.refine_min_distinct),
        "health": report.group_health(detail),
        "reassignments": reassignments(detail, topics(pool), c=settings.classifying),
    }


def merge_all(store: Store, pool: DataFrame, model: TextModel, settings: Settings, at: str) -> DataFrame:
    """A merge mapping of all topics of all groups, stored; overall topics stay what they are."""
    target = overall_name(F.col("sc_measurement"))
    found = joins.complete_mapping(pool, merge_proposals(pool, model), F.contains("source_topic", target), target)
    store.write("topic_merge_mapping", found.withColumns({"run_id": F.lit(settings.run_id), "created_at": F.lit(at)}), "replace", GROUP)
    return store.read("topic_merge_mapping")


def design_all(store: Store, raw: DataFrame, model: TextModel, settings: Settings, versions: dict[str, str], at: str, least: int = 7, most: int = 17) -> DataFrame:
    """Profiles and topic pools of all groups that are large enough, stored by group and version.

    Returns the groups whose pool stayed out of bounds, with the reason; they get no pool.
    """
    s = settings.sampling
    memos = dedupe_for_sampling(with_memo_id(eligible(raw, s.excluded_prefix, s.sentiments, snippets=settings.source_filters)))
    large = memos.join(target_groups(memos, s.min_group_size).select(*GROUP), list(GROUP), "left_semi")
    samples = diverse_sample(large, s.max_prompt_rows, s.max_rule_sample_rows, s.design_seed).select(*GROUP, "memo", "prompt_rn")
    stamp = {**{v: F.lit(versions.get(v)) for v in VERSION}, "run_id": F.lit(settings.run_id), "run_date": F.lit(settings.run_date), "created_at": F.lit(at), "created_by": F.lit("pipeline")}
    store.write("rule_profile", design_profiles(samples, model).withColumns(stamp), "replace", KEY, schema("rule_profile"))
    store.write("topic_pool_designed", design_pools(samples, model, least, most).withColumns(stamp), "replace", KEY)
    made = store.read("topic_pool_designed")
    store.write("topic_pool", made.where("error is null"), "replace", KEY, schema("topic_pool"))
    return made.where("error is not null").select(*GROUP, "error")


def expand_all(store: Store, raw: DataFrame, settings: Settings, at: str) -> dict[str, int]:
    """Fans the latest labels out to all raw rows and replaces their groups; returns counts that add up."""
    keyed = with_memo_id(raw)
    detail = latest(store.read("classification_detail"), [*GROUP, "memo_id"], ["is_latest", "created_at", "run_id"], [*VERSION, "pred_topic", "classification_stage", "memo"])
    labels = ("pred_topic", "pred_topic_type", "classification_stage", "confidence_score", "candidate_topics_json", "match_reason", "llm_used_yn", "review_needed_yn", *VERSION)
    full = joins.expand(keyed, detail, labels).withColumns({"run_id": F.lit(settings.run_id), "run_date": F.lit(settings.run_date), "created_at": F.lit(at)})
    store.write("classification_full", full, "replace", KEY, schema("classification_full"))
    return {"raw_rows": keyed.count(), "full_rows": store.read("classification_full").where(F.col("run_id") == settings.run_id).count(), "unmatched_raw_rows": joins.unmatched(keyed, detail).count()}


def summarise_all(store: Store, settings: Settings, at: str) -> DataFrame:
    out = report.rounded(report.summary(store.read("classification_detail"))).withColumns({"run_id": F.lit(settings.run_id), "run_date": F.lit(settings.run_date), "created_at": F.lit(at)})
    store.write("classification_summary", out, "replace", (*KEY, "run_id"), schema("classification_summary"))
    return store.read("classification_summary")


def embed_new(store: Store, settings: Settings, encoder: Encoder, at: str) -> int:
    """Encodes trusted labels that have no vector of this model yet; returns how many."""
    detail = latest(trusted(store.read("classification_detail"), settings.embedding.min_confidence, settings.classifying.others_label, settings.embedding.label_types), [*KEY, "memo_id"], ["created_at", "run_id"], ["pred_topic", "classification_stage", "memo"])
    keys = [*KEY, "memo_id", "embedding_model"]
    new = detail.withColumn("embedding_model", F.lit(encoder.name))
    if store.exists("memo_embedding"):
        new = increment(new, store.read("memo_embedding"), keys)
    out = encode(new.drop("embedding_model"), encoder, batch=settings.embedding.batch).withColumns({"label_source_table_key": F.lit("classification_detail"), "created_at": F.lit(at)})
    before = store.read("memo_embedding").count() if store.exists("memo_embedding") else 0
    store.write("memo_embedding", out, "append", schema=schema("memo_embedding"))
    return store.read("memo_embedding").count() - before


def attempts(run: Callable[[], object], n: int = 5, pause: Callable[[int], None] = lambda k: None) -> object:
    """Runs again after a failure, up to ``n`` times in all; the last failure is raised."""
    for k in range(1, n + 1):
        try:
            return run()
        except Exception:
            if k == n:
                raise
            pause(k)
    raise AssertionError
