"""Reproducible samples of all groups in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import GROUP, sampling_key
from ..functions.text import length_bucket
from .rows import first_by

STRATUM = (("year", "unknown_year"), ("country", "unknown_country"), ("brand_name", "unknown_brand"), ("device_type", "unknown_dtype"))


def dedupe_for_sampling(df: DataFrame, tie: str | None = None) -> DataFrame:
    """One row a memo id, that of the smallest memo."""
    return first_by(df, ["memo_id"], [F.asc_nulls_last("memo")] + ([F.asc(tie)] if tie else []))


def dedupe_for_classification(df: DataFrame, tie: str | None = None) -> DataFrame:
    """One row a memo id within its group, the smallest by its metadata, nulls last."""
    order = [F.asc_nulls_last(c) for c in ("year", "country", "brand_name", "device_type", "memo")]
    return first_by(df, [*GROUP, "memo_id"], order + ([F.asc(tie)] if tie else []))


def target_groups(df: DataFrame, min_size: int, limit: int | None = None) -> DataFrame:
    """Groups with enough distinct memos, in order."""
    sizes = df.groupBy(*GROUP).agg(F.count_distinct("memo_id").alias("memo_cnt")).where(F.col("memo_cnt") >= min_size)
    ordered = sizes.orderBy(*GROUP)
    return ordered.limit(limit) if limit else ordered


def group_sample(df: DataFrame, rows: int, seed: str, rank: str | None = None) -> DataFrame:
    """Up to ``rows`` rows of each group by a hash of memo, group and seed."""
    return first_by(df, GROUP, [sampling_key("memo_id", *GROUP, F.lit(seed)), F.asc("memo_id")], rows, rank)


def hash_order_sample(df: DataFrame, rows: int, seed: str) -> DataFrame:
    """Up to ``rows`` rows of each group by a hash of memo and seed; 0 or less: all."""
    return first_by(df, GROUP, [sampling_key("memo_id", F.lit(seed)), F.asc("memo_id")], rows) if rows > 0 else df


def with_stratum(df: DataFrame) -> DataFrame:
    known = [F.coalesce(F.col(c).cast("string"), F.lit(d)) for c, d in STRATUM]
    return df.withColumn("stratum", F.concat_ws("||", *known, F.expr(length_bucket("coalesce(memo_norm, memo)"))))


def diverse_sample(df: DataFrame, rows: int, base_rows: int, seed: str) -> DataFrame:
    """Takes turns between the strata of a group: first of each, second of each, and so on; adds ``prompt_rn``."""
    base = with_stratum(group_sample(df, base_rows, seed))
    turn = first_by(base, [*GROUP, "stratum"], [sampling_key("memo_id", F.lit(seed)), F.asc("memo_id")], rows, "within_rn")
    return first_by(turn, GROUP, [F.asc("within_rn"), sampling_key("stratum", "memo_id", F.lit(seed)), F.asc("memo_id")], rows, "prompt_rn").drop("stratum", "within_rn")


def preview(df: DataFrame, n: int, seed: str, *parts: str) -> DataFrame:
    """``n`` rows that look picked at random but are the same each time, by a hash of ``parts`` and the seed."""
    return df.orderBy(sampling_key(*parts, F.lit(seed)), *[F.asc_nulls_first(p) for p in parts]).limit(n)
