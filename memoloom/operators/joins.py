"""Labels fanned out to rows, lookups and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import GROUP
from ..functions.text import clean

LABEL = ("pred_topic", "pred_topic_type", "classification_stage", "confidence_score")


def expand(raw: DataFrame, detail: DataFrame, labels: tuple[str, ...] = LABEL) -> DataFrame:
    """Every raw row with the labels of its memo. ``detail`` has one row a group and memo; null groups don't match."""
    return raw.join(detail.select(*GROUP, "memo_id", *labels), [*GROUP, "memo_id"], "inner")


def unmatched(raw: DataFrame, detail: DataFrame) -> DataFrame:
    """Raw rows that no label reaches; with those of :func:`expand` they are all."""
    return raw.join(detail.select(*GROUP, "memo_id"), [*GROUP, "memo_id"], "left_anti")


def with_category_labels(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds the mapped category labels, and the labels themselves where the mapping has none."""
    m = mapping.groupBy("cate_1_depth", "cate_2_depth").agg(F.min("cate_1_depth_kor").alias("_k1"), F.min("cate_2_depth_kor").alias("_k2"))
    out = df.join(m, ["cate_1_depth", "cate_2_depth"], "left")
    return out.withColumn("cate_1_label", F.coalesce("_k1", "cate_1_depth")).withColumn("cate_2_label", F.coalesce("_k2", "cate_2_depth")).drop("_k1", "_k2")


def pool_with_share(pool: DataFrame, share: DataFrame) -> DataFrame:
    """Topics of the pool with their rows and share, 0 where no row has them."""
    s = share.select(*GROUP, F.col("pred_topic").alias("topic"), "review_count", "topic_share")
    out = pool.join(s, [*GROUP, "topic"], "left")
    return out.withColumn("review_count", F.coalesce("review_count", F.lit(0))).withColumn("topic_share", F.coalesce("topic_share", F.lit(0.0)))


def merged_topics(detail: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows with ``merged_topic``: what the mapping says, else the topic itself."""
    m = mapping.select(*GROUP, F.col("source_topic").alias("pred_topic"), F.col("merged_topic").alias("_m"))
    m = m.groupBy(*GROUP, "pred_topic").agg(F.min("_m").alias("_m"))
    return detail.join(m, [*GROUP, "pred_topic"], "left").withColumn("merged_topic", F.coalesce("_m", "pred_topic")).drop("_m")


def identity_mapping(detail: DataFrame, mapping: DataFrame) -> DataFrame:
    """The mapping, and each topic of the rows that it lacks mapped to itself."""
    topics = detail.where("pred_topic is not null").select(*GROUP, F.col("pred_topic").alias("source_topic")).distinct()
    left = topics.join(mapping.select(*GROUP, "source_topic"), [*GROUP, "source_topic"], "left_anti")
    return mapping.select(*GROUP, "source_topic", "merged_topic").unionByName(left.withColumn("merged_topic", F.col("source_topic")))


def locked_topic(name: Column, description: Column, target: Column, sentiment_markers: tuple[str, ...], vague_markers: tuple[str, ...]) -> Column:
    """Whether a topic must stay the overall one: it names the target, or a sentiment with vague words."""
    both = F.concat_ws(" ", name, description)
    has = lambda x, terms: F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(F.lower(x), F.lower(t))) if terms else F.lit(False)
    return F.contains(name, target) | (has(name, sentiment_markers) & has(both, vague_markers))


def complete_mapping(pool: DataFrame, proposed: DataFrame, locked: Column | None = None, target: Column | None = None, reason: str = "locked") -> DataFrame:
    """A mapping with one row for each topic of the pool, from proposals (``source_topic``, ``merged_topic``,
    ``merged_description``, ``merge_reason``).

    Proposals for topics that aren't in the pool go; of several for one topic the smallest stays; a topic without one,
    or with a blank one, is mapped to itself. Topics for which ``locked`` holds are mapped to ``target``.
    """
    topics = pool.select(*GROUP, F.col("topic").alias("source_topic"), F.coalesce("description", F.lit("")).alias("_told"))
    topics = topics.where(f"{clean('source_topic')} <> ''").groupBy(*GROUP, "source_topic").agg(F.min("_told").alias("_told"))
    one = proposed.groupBy(*GROUP, "source_topic").agg(F.min(F.struct("merged_topic", "merged_description", "merge_reason")).alias("_p"))
    out = topics.join(one, [*GROUP, "source_topic"], "left")
    text = lambda c, other: F.when(F.expr(clean(f"_p.{c}")) != "", F.expr(clean(f"_p.{c}"))).otherwise(other)
    stay = F.lit(False) if locked is None else F.coalesce(locked, F.lit(False))
    return out.select(
        *GROUP,
        "source_topic",
        F.when(stay, target if target is not None else F.col("source_topic")).otherwise(text("merged_topic", F.col("source_topic"))).alias("merged_topic"),
        F.when(stay, "").otherwise(text("merged_description", F.col("_told"))).alias("merged_description"),
        F.when(stay, reason).otherwise(text("merge_reason", F.lit("itself"))).alias("merge_reason"),
    )
