"""Shares, ratios and counts by group, and candidates for new topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import GROUP, VERSION
from ..functions.numbers import ratio
from .rows import first_by, total_over

KEYS = (*GROUP, *VERSION)


def _is(kind: str) -> Column:
    return F.col("pred_topic_type") == kind


def group_counts(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Conditional counts of each group and their guarded ratios, in one pass."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_cnt"),
        F.count_if(_is("overall")).alias("overall_cnt"),
        F.count_if(_is("others")).alias("others_cnt"),
        F.count_if("llm_used_yn").alias("llm_used_cnt"),
        F.count_if("review_needed_yn").alias("review_needed_cnt"),
    )
    for c in ("overall", "others", "llm_used", "review_needed"):
        out = out.withColumn(f"{c}_ratio", ratio(F.col(f"{c}_cnt"), F.col("total_cnt")))
    return out


def summary(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Rows of each topic, its share of the group, and the group's counts; one shuffle by topic, one by group."""
    topics = df.groupBy(*keys, "pred_topic", "pred_topic_type").agg(
        F.count(F.lit(1)).alias("topic_cnt"), F.count_if("llm_used_yn").alias("llm_used"), F.count_if("review_needed_yn").alias("review_needed")
    )
    topics = topics.withColumn("overall", F.when(_is("overall"), F.col("topic_cnt")).otherwise(0)).withColumn("others", F.when(_is("others"), F.col("topic_cnt")).otherwise(0))
    out = total_over(topics, keys, "topic_cnt", "total_cnt")
    for c in ("overall", "others", "llm_used", "review_needed"):
        out = total_over(out, keys, c, f"{c}_cnt").drop(c)
    return out.withColumn("topic_ratio", ratio(F.col("topic_cnt"), F.col("total_cnt")))


def rounded(df: DataFrame, column: str = "topic_ratio") -> DataFrame:
    """Share to four decimals, and in percent to two."""
    return df.withColumn("topic_pct", F.round(F.col(column) * 100, 2)).withColumn(column, F.round(column, 4))


def others_summary(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Of rows without a topic: how many, how many different, how many of a model and for review."""
    out = df.where(_is("others")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("others_cnt"),
        F.count_distinct("memo_norm").alias("distinct_memo_norm_cnt"),
        F.count_distinct("memo_id").alias("distinct_memo_id_cnt"),
        F.count_if("llm_used_yn").alias("llm_used_cnt"),
        F.count_if("review_needed_yn").alias("review_needed_cnt"),
    )
    for c in ("llm_used", "review_needed"):
        out = out.withColumn(f"{c}_ratio", ratio(F.col(f"{c}_cnt"), F.col("others_cnt")))
    return out


def new_topic_candidates(df: DataFrame, min_count: int, min_ratio: float, min_distinct: int = 1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Memos without a topic that recur: enough rows, ids and share of the group's others; smallest memo as sample."""
    found = df.where(_is("others") & (F.coalesce("memo_norm", F.lit("")) != "")).groupBy(*keys, "memo_norm").agg(
        F.count(F.lit(1)).alias("candidate_cnt"),
        F.count_distinct("memo_id").alias("distinct_memo_id_cnt"),
        F.min("memo").alias("sample_memo"),
        F.min("match_reason").alias("sample_reason"),
        F.count_distinct("match_reason").alias("reason_cnt"),
    )
    found = total_over(found, keys, "candidate_cnt", "others_cnt")
    found = found.withColumn("candidate_ratio", ratio(F.col("candidate_cnt"), F.col("others_cnt")))
    return found.where((F.col("candidate_cnt") >= min_count) & (F.col("candidate_ratio") >= min_ratio) & (F.col("distinct_memo_id_cnt") >= min_distinct))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def group_health(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("memo_id").alias("distinct_memo_cnt"), F.count_if(_is("others")).alias("others_cnt"))
    return out.withColumn("others_ratio", ratio(F.col("others_cnt"), F.col("row_cnt")))


def totals(df: DataFrame) -> DataFrame:
    """One row of counts by kind over all rows."""
    return df.agg(
        F.count(F.lit(1)).alias("row_cnt"),
        *[F.count_if(_is(k)).alias(f"{k}_cnt") for k in ("overall", "topic", "others", "ambiguous")],
        F.count_if("llm_used_yn").alias("llm_used_cnt"),
        F.count_if("review_needed_yn").alias("review_needed_cnt"),
    )


def topic_share(df: DataFrame, keys: tuple[str, ...] = GROUP, topic: str = "pred_topic") -> DataFrame:
    """Rows of each topic and their share of the group."""
    n = df.groupBy(*keys, topic).agg(F.count(F.lit(1)).alias("review_count"))
    return total_over(n, keys, "review_count", "group_count").withColumn("topic_share", ratio(F.col("review_count"), F.col("group_count")))


def share_of_all(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows and distinct memos by key, and the share of all rows; only the counts meet in one place."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("memo_id").alias("memo_cnt"))
    return total_over(n, (), "row_cnt", "all_cnt").withColumn("row_ratio", ratio(F.col("row_cnt"), F.col("all_cnt")))


def topic_lines(pool: DataFrame, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """Each group's topics in order as ``order. topic: description``."""
    entry = F.struct("topic_order", F.col("topic"), F.coalesce("description", F.lit("")).alias("description"))
    ordered = pool.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("t"))
    line = F.transform("t", lambda s: F.concat(s["topic_order"].cast("string"), F.lit(". "), s["topic"], F.lit(": "), s["description"]))
    return ordered.select(*keys, F.array_join(line, "\n").alias("topics_text"))


def rare_topics(df: DataFrame, min_rows: int, locked: Column | None = None, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """Topics of fewer rows than ``min_rows``, but for locked ones."""
    n = df.groupBy(*keys, "pred_topic").agg(F.count(F.lit(1)).alias("row_cnt")).where(F.col("row_cnt") < min_rows)
    return n.where(~F.coalesce(locked, F.lit(False))) if locked is not None else n


def fold_rare(df: DataFrame, min_rows: int, into: str, locked: Column | None = None, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """Rows with ``final_topic``: the topic, or ``into`` where it is rare. Counts of topics join back, not rows."""
    rare = rare_topics(df, min_rows, locked, keys).select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate((*keys, "pred_topic"))], F.lit(True).alias("_rare"))
    on = None
    for i, k in enumerate((*keys, "pred_topic")):
        same = F.col(k).eqNullSafe(F.col(f"_r{i}"))
        on = same if on is None else on & same
    return df.join(rare, on, "left").withColumn("final_topic", F.when(F.col("_rare"), F.lit(into)).otherwise(F.col("pred_topic"))).drop("_rare", *[f"_r{i}" for i in range(len(keys) + 1)])


def topic_options(pool: DataFrame, keys: tuple[str, ...] = GROUP) -> DataFrame:
    return pool.groupBy(*keys).agg(F.sort_array(F.collect_set("topic")).alias("topics"))


def repeats(df: DataFrame, n: int) -> DataFrame:
    """Memos that occur most often under a topic."""
    c = df.groupBy(*GROUP, "memo_id", "pred_topic").agg(F.count(F.lit(1)).alias("row_cnt"))
    return top(c, n, F.desc("row_cnt"), *[F.asc_nulls_first(k) for k in (*GROUP, "memo_id", "pred_topic")])


def by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_topics(df: DataFrame, n: int, keys: tuple[str, ...] = ("sc_measurement",)) -> DataFrame:
    """The ``n`` most frequent topics of each key, ties by name."""
    c = df.where("pred_topic is not null").groupBy(*keys, "pred_topic").agg(F.count(F.lit(1)).alias("row_cnt"))
    return first_by(c, keys, [F.desc("row_cnt"), F.asc("pred_topic")], n, "rank")


def kpis(df: DataFrame) -> DataFrame:
    """Rows, rows without a topic, different memos and topics, in one row."""
    return df.agg(F.count(F.lit(1)).alias("row_cnt"), F.count_if(_is("others")).alias("others_cnt"), F.count_distinct("memo_id").alias("memo_cnt"), F.count_distinct("pred_topic").alias("topic_cnt"))


def reconciliation(detail: DataFrame, full: DataFrame) -> DataFrame:
    """Rows and memos before and after the fan-out, and rows for each memo."""
    a = detail.agg(F.count(F.lit(1)).alias("detail_rows"), F.count_distinct("memo_id").alias("detail_memos"))
    b = full.agg(F.count(F.lit(1)).alias("full_rows"), F.count_distinct("memo_id").alias("full_memos"))
    return a.join(b, F.lit(True)).withColumn("rows_per_memo", ratio(F.col("full_rows"), F.col("full_memos")))
