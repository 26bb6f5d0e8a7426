"""Schemas of the tables, as types by column, and projection onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_GROUP = "cate_1_depth string, cate_2_depth string, sc_measurement int"
_VERSION = "prompt_version string, taxonomy_version string, model_version string, pipeline_version string"
_AUDIT = "created_at string, created_by string"
_MEMO = "memo_id string, memo string, memo_norm string"
_LABEL = "pred_topic string, pred_topic_type string, classification_stage string, confidence_score double"
_META = "year string, country string, brand_name string, device_type string"
_PERIOD = "source_period_start string, source_period_end string, is_latest boolean"
_RUN = "run_id string, run_date string"

TABLES = {
    "raw_review": f"{_GROUP}, {_META}, memo string",
    "rule_profile": f"{_GROUP}, overall_topic_name string, overall_allowed_rule string, overall_block_rule string, overall_sentiment_terms_json string, feature_hint_terms_json string, reason_signal_terms_json string, non_overall_examples_json string, {_RUN}, {_VERSION}, {_AUDIT}",
    "topic_pool": f"{_GROUP}, topic_order int, topic string, description string, representative_memos_json string, topic_count int, {_RUN}, {_VERSION}, {_PERIOD}, {_AUDIT}",
    "classification_detail": f"{_MEMO}, {_GROUP}, {_META}, {_LABEL}, candidate_topics_json string, match_reason string, llm_used_yn boolean, review_needed_yn boolean, {_RUN}, pipeline_stage string, {_VERSION}, {_PERIOD}, {_AUDIT}",
    "classification_full": f"{_MEMO}, {_GROUP}, {_META}, {_LABEL}, candidate_topics_json string, match_reason string, llm_used_yn boolean, review_needed_yn boolean, classification_run_id string, {_RUN}, pipeline_stage string, {_VERSION}, {_PERIOD}, {_AUDIT}",
    "classification_summary": f"{_GROUP}, pred_topic string, pred_topic_type string, topic_cnt int, topic_ratio double, topic_pct double, total_cnt int, overall_cnt int, others_cnt int, llm_used_cnt int, review_needed_cnt int, overall_ratio double, others_ratio double, llm_used_ratio double, review_needed_ratio double, {_RUN}, {_VERSION}, {_AUDIT}",
    "review_decision": f"decision_id string, candidate_type string, {_GROUP}, memo_id string, memo_norm string, sample_memo string, current_pred_topic string, current_pred_topic_type string, suggested_action string, suggested_topic string, suggestion_score double, candidate_cnt int, candidate_distinct_memo_id_cnt int, candidate_ratio double, candidate_evidence_json string, decision_status string, approved_action string, approved_topic string, reviewer string, review_comment string, reviewed_at string, source_table_key string, {_RUN}, {_VERSION}, {_AUDIT}",
    "topic_pool_revision": f"revision_id string, revision_type string, {_GROUP}, source_decision_id string, proposed_topic string, proposed_description string, representative_memos_json string, evidence_json string, revision_status string, {_RUN}, {_VERSION}, {_AUDIT}",
    "memo_embedding": f"{_MEMO}, {_GROUP}, {_LABEL}, review_needed_yn boolean, llm_used_yn boolean, embedding_text string, embedding array<float>, embedding_model string, embedding_dim int, embedding_normalized boolean, label_source_table_key string, {_RUN}, {_VERSION}, {_AUDIT}",
    "topic_prototype": f"{_GROUP}, pred_topic string, prompt_version string, taxonomy_version string, model_version string, embedding_model string, embedding_dim int, prototype array<double>, memo_cnt bigint, distinct_memo_cnt bigint, avg_confidence double",
    "pipeline_progress": "checkpoint_key string, pipeline_name string, " + _GROUP + ", step string, status string, message string, row_cnt bigint, topic_cnt bigint, logged_at string, " + _RUN,
    "category_mapping": "cate_1_depth string, cate_2_depth string, cate_1_depth_kor string, cate_2_depth_kor string",
    "topic_merge_mapping": f"{_GROUP}, source_topic string, merged_topic string, merged_description string, merge_reason string",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schema(name))


def from_rows(spark: SparkSession, rows: list[dict], name: str) -> DataFrame:
    """A frame of a table's columns from rows as dicts, for small dimensions: missing keys are null, others dropped;
    a value of the wrong type is an error."""
    to = schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in to) for r in rows], to)


def from_pandas(spark: SparkSession, frame, name: str) -> DataFrame:
    """The same from a pandas frame; its missing values are null."""
    import pandas as pd

    return from_rows(spark, [{k: None if v is None or v is pd.NA or v is pd.NaT or v != v else getattr(v, "item", lambda v=v: v)() for k, v in r.items()} for r in frame.to_dict("records")], name)


def conform(df: DataFrame, to: T.StructType) -> DataFrame:
    """Exactly the columns of ``to``, in order and cast; missing ones are null, others are dropped."""
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in to])


def require(df: DataFrame, *columns: str) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def ensure(df: DataFrame, name: str, default=None) -> DataFrame:
    """Adds a column unless it is there; ``default`` is a Column or a plain value."""
    if name in df.columns:
        return df
    return df.withColumn(name, default if hasattr(default, "_jc") or hasattr(default, "_expr") else F.lit(default))
