"""Decisions on labels: proposals, approved edits, their overlay on classifications, and revisions of topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DECISION_ACTIONS, DECISION_STATUSES
from ..functions.identity import GROUP, VERSION, surrogate_key
from ..schemas import conform, require, schema
from .rows import latest

KEY = (*GROUP, "memo_id", *VERSION)


# The names of states and actions below stand in stored tables and in their readers.


def from_reassignments(df: DataFrame, source: str = "classification_detail") -> DataFrame:
    """Pending decisions of proposed topics; the id follows the content, so that a rerun gives the same ids."""
    kind = F.lit("reassign_existing_topic")
    versions = [c for c in VERSION if c in df.columns]
    out = df.withColumn("decision_id", surrogate_key(kind, *GROUP, "memo_id", "suggested_topic", *versions))
    out = out.withColumns({"candidate_type": kind, "suggested_action": kind, "decision_status": F.lit("pending"), "source_table_key": F.lit(source), "candidate_evidence_json": F.to_json(F.struct("suggested_topic", "suggestion_score"))})
    return conform(out, schema("review_decision"))


def from_candidates(df: DataFrame, source: str = "classification_detail") -> DataFrame:
    """Pending decisions of new topics, by normalised memo; they belong to no single memo id."""
    kind = F.lit("create_new_topic")
    versions = [c for c in VERSION if c in df.columns]
    out = df.withColumn("decision_id", surrogate_key(kind, *GROUP, "memo_norm", *versions))
    out = out.withColumns({"candidate_type": kind, "suggested_action": kind, "memo_id": F.lit(""), "decision_status": F.lit("pending"), "source_table_key": F.lit(source), "candidate_distinct_memo_id_cnt": F.col("distinct_memo_id_cnt"), "candidate_evidence_json": F.to_json(F.struct("candidate_cnt", "candidate_ratio"))})
    return conform(out, schema("review_decision"))


def from_edits(candidates: DataFrame, edits: DataFrame, reviewed_at: str) -> DataFrame:
    """Approved decisions from reviewers' rows; a reassignment without a topic is an error, other actions are skipped."""
    require(edits, "memo_id", "approved_action", "approved_topic", "reviewer", "review_comment")
    used = edits.where(F.col("approved_action").isin("reassign_existing_topic", "keep_others"))
    if not used.where((F.col("approved_action") == "reassign_existing_topic") & (F.trim(F.coalesce("approved_topic", F.lit(""))) == "")).isEmpty():
        raise ValueError("a reassignment needs a topic")
    out = candidates.join(used, "memo_id").withColumn("decision_id", surrogate_key(*GROUP, "memo_id", "approved_action", "approved_topic", *[c for c in VERSION if c in candidates.columns]))
    out = out.withColumns({"decision_status": F.lit("approved"), "reviewed_at": F.lit(reviewed_at), "candidate_type": F.lit("manual"), "current_pred_topic": F.col("pred_topic"), "current_pred_topic_type": F.col("pred_topic_type")})
    return conform(out, schema("review_decision"))


def approved(decisions: DataFrame) -> DataFrame:
    """The latest approved decision of each memo and version that keeps or reassigns it."""
    ok = decisions.where((F.col("decision_status") == "approved") & F.col("approved_action").isin("reassign_existing_topic", "keep_others") & (F.coalesce("memo_id", F.lit("")) != ""))
    return latest(ok, list(KEY), ["reviewed_at", "created_at"], ["decision_id"])


def overlay(detail: DataFrame, decisions: DataFrame, others: str = "기타") -> DataFrame:
    """Classifications with the approved decisions of their own version applied; all other rows unchanged."""
    d = approved(decisions).select(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(KEY)], F.col("approved_action").alias("_action"), F.col("approved_topic").alias("_topic"), F.col("reviewer").alias("_who"))
    on = None
    for i, k in enumerate(KEY):
        same = F.col(k).eqNullSafe(F.col(f"_d{i}"))
        on = same if on is None else on & same
    joined = detail.join(d, on, "left")
    move = (F.col("_action") == "reassign_existing_topic") & (F.trim(F.coalesce("_topic", F.lit(""))) != "")
    keep = F.col("_action") == "keep_others"
    hit = F.coalesce(move | keep, F.lit(False))
    pick = lambda a, b, old: F.when(F.coalesce(move, F.lit(False)), a).when(F.coalesce(keep, F.lit(False)), b).otherwise(old)
    new = {
        "pred_topic": pick(F.col("_topic"), F.lit(others), F.col("pred_topic")),
        "pred_topic_type": pick(F.lit("topic"), F.lit("others"), F.col("pred_topic_type")),
        "classification_stage": pick(F.lit("human_fallback_reassign"), F.lit("human_fallback_keep_others"), F.col("classification_stage")),
        "confidence_score": F.when(hit, 1.0).otherwise(F.col("confidence_score")),
        "review_needed_yn": F.when(hit, False).otherwise(F.col("review_needed_yn")),
        "match_reason": F.when(hit, F.concat_ws(" | ", "_action", "_who", "match_reason")).otherwise(F.col("match_reason")),
    }
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in detail.columns])


def checked(status: str, action: str = "") -> None:
    """ValueError for a status or an action that no reader of decisions knows; no action is allowed."""
    if status not in DECISION_STATUSES:
        raise ValueError(f"decision status {status!r} is none of {DECISION_STATUSES}")
    if action and action not in DECISION_ACTIONS:
        raise ValueError(f"approved action {action!r} is none of {DECISION_ACTIONS}")


def updated(decisions: DataFrame, which: Column, status: str, reviewed_at: str, action: str = "", topic: str | None = None, reviewer: str | None = None, comment: str | None = None) -> DataFrame:
    """All decisions, those for which ``which`` holds with a new status and what comes with it; the rest as it was."""
    checked(status, action)
    hit = F.coalesce(which, F.lit(False))
    given = {"decision_status": status, "approved_action": action or None, "approved_topic": topic, "reviewer": reviewer, "review_comment": comment, "reviewed_at": reviewed_at}
    return decisions.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in given.items() if v is not None})


def applied_counts(detail: DataFrame, decisions: DataFrame, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """What :func:`overlay` does, by group: rows, rows reassigned and rows kept without a topic."""
    stage = F.col("classification_stage")
    out = overlay(detail.withColumn("classification_stage", F.lit(None).cast("string")), decisions)
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"), F.count_if(stage == "human_fallback_reassign").alias("reassigned_cnt"), F.count_if(stage == "human_fallback_keep_others").alias("kept_cnt"))


def revisions(decisions: DataFrame) -> DataFrame:
    """Proposals for the topic pool from approved decisions that add or revise topics."""
    ok = decisions.where((F.col("decision_status") == "approved") & F.col("approved_action").isin("create_new_topic", "revise_topic_pool"))
    topic = F.when(F.trim(F.coalesce("approved_topic", F.lit(""))) != "", F.col("approved_topic")).otherwise(F.col("memo_norm"))
    kind = F.when(F.col("approved_action") == "create_new_topic", "add_topic").otherwise("revise_topic_pool")
    out = ok.withColumn("revision_type", kind).withColumn("proposed_topic", topic)
    out = out.withColumns({
        "revision_id": surrogate_key("revision_type", *GROUP, "decision_id", "proposed_topic", *VERSION),
        "source_decision_id": F.col("decision_id"),
        "proposed_description": F.concat_ws(" ", F.lit("from review:"), F.coalesce("review_comment", F.lit(""))),
        "representative_memos_json": F.to_json(F.array_compact(F.array("sample_memo"))),
        "evidence_json": F.col("candidate_evidence_json"),
        "revision_status": F.lit("proposed"),
    })
    return conform(out, schema("topic_pool_revision"))


def manual(rows: DataFrame, reviewed_at: str) -> DataFrame:
    """Decisions typed in by hand: the action follows from whether a topic is given; rows without a memo id are skipped."""
    has = F.trim(F.coalesce("approved_topic", F.lit(""))) != ""
    out = rows.where(F.trim(F.coalesce("memo_id", F.lit(""))) != "").withColumn("approved_action", F.when(has, "reassign_existing_topic").otherwise("keep_others"))
    out = out.withColumns({"decision_status": F.lit("approved"), "reviewed_at": F.lit(reviewed_at), "decision_id": surrogate_key(*GROUP, "memo_id", "approved_action", "approved_topic", "reviewer")})
    return conform(out, schema("review_decision"))
