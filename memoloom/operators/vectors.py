"""Prototypes of topics, routing by the nearest, and their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import GROUP, VERSION, sampling_key
from ..functions.numbers import dot, unit
from .rows import first_by

TOPIC = (*GROUP, *VERSION, "pred_topic", "embedding_model")


def trusted(df: DataFrame, min_confidence: float = 0.6, others: str = "기타", types: tuple[str, ...] = ("topic", "overall")) -> DataFrame:
    """Labels that may teach: of trusted stages, or of a scored stage with enough confidence; no others, no
    superseded rows and none that wait for a review (where the columns exist)."""
    stages = ("llm_fallback", "llm_reason_recovered", "rule_overall", "rule_overall_target_sentiment")
    scored = ("heuristic_topic_match",)
    sure = F.col("classification_stage").isin(*stages) | (F.col("classification_stage").isin(*scored) & (F.coalesce("confidence_score", F.lit(0.0)) >= min_confidence))
    out = df.where(F.col("memo_id").isNotNull() & F.col("pred_topic").isNotNull() & (F.col("pred_topic") != others) & F.col("pred_topic_type").isin(*types) & sure)
    if "is_latest" in df.columns:
        out = out.where(F.coalesce("is_latest", F.lit(True)))
    if "review_needed_yn" in df.columns:
        out = out.where(~F.coalesce("review_needed_yn", F.lit(False)))
    return out


def embeddings(df: DataFrame, model: str | None = None, dim: int | None = None) -> DataFrame:
    """Rows with a vector, of one model and length if named, none of its elements null or NaN."""
    out = df.where(F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)))
    if model is not None:
        out = out.where(F.col("embedding_model") == model)
    return out.where(F.size("embedding") == dim) if dim is not None else out


def quality(df: DataFrame) -> dict[str, DataFrame]:
    """Counts in all, by topic, of repeated keys and of topics with fewer than three memos."""
    overall = df.agg(F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("memo_id").alias("memo_cnt"), F.count_if(F.col("embedding").isNull()).alias("null_cnt"), F.count_distinct(F.size("embedding")).alias("dim_cnt"))
    topics = df.groupBy(*TOPIC).agg(F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("memo_id").alias("memo_cnt"))
    return {
        "overall": overall,
        "topics": topics,
        "repeats": df.groupBy(*GROUP, *VERSION, "memo_id", "embedding_model").agg(F.count(F.lit(1)).alias("row_cnt")).where("row_cnt > 1"),
        "sparse": topics.where("memo_cnt < 3"),
    }


def prototypes(df: DataFrame, min_memos: int = 3) -> DataFrame:
    """Mean vector of each topic, of unit length, with counts; topics of fewer distinct memos are left out.

    Vectors are summed element by element in one aggregation by topic and position; map-side sums keep the
    shuffle at (topics x elements), whatever the number of memos.
    """
    base = df.withColumn("embedding_dim", F.size("embedding"))
    keys = (*TOPIC, "embedding_dim")
    known = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("memo_cnt"), F.count_distinct("memo_id").alias("distinct_memo_cnt"), F.avg("confidence_score").alias("avg_confidence")).where(F.col("distinct_memo_cnt") >= min_memos)
    parts = base.select(*keys, F.posexplode("embedding").alias("pos", "x")).groupBy(*keys, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    mean = parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("mean"))
    joined = known.join(mean, list(keys))
    return joined.withColumn("prototype", unit(F.col("mean"))).drop("mean")


def nearest(df: DataFrame, protos: DataFrame, auto: float, fallback: float, top_k: int) -> DataFrame:
    """The most similar prototypes of each memo in its group, version, model and dimension, and the route.

    One aggregation keeps the best and the ordered list; ties go to the prototype of more memos, then by name.
    """
    right = protos.select(*GROUP, *VERSION, "embedding_model", F.col("embedding_dim").alias("_dim"), F.col("pred_topic").alias("prototype_topic"), "distinct_memo_cnt", "prototype")
    pairs = df.withColumn("_dim", F.size("embedding")).withColumn("_unit", unit(F.col("embedding"))).withColumnRenamed("pred_topic", "true_topic").select(*GROUP, *VERSION, "embedding_model", "_dim", "memo_id", "true_topic", "_unit").join(right, [*GROUP, *VERSION, "embedding_model", "_dim"])
    pairs = pairs.withColumn("similarity", dot(F.col("_unit"), F.col("prototype"))).where("similarity is not null")
    ranked = first_by(pairs, [*GROUP, *VERSION, "embedding_model", "memo_id"], [F.desc("similarity"), F.desc("distinct_memo_cnt"), F.asc("prototype_topic")], top_k, "rank")
    entry = F.struct("rank", F.col("prototype_topic").alias("topic"), F.round("similarity", 6).alias("similarity"))
    best = lambda c: F.min_by(c, "rank").alias(c)
    out = ranked.groupBy(*GROUP, *VERSION, "embedding_model", "memo_id").agg(best("true_topic"), best("prototype_topic"), best("similarity"), F.to_json(F.sort_array(F.collect_list(entry))).alias("top_json"))
    route = F.when(F.col("similarity") >= auto, "auto_accept").when(F.col("similarity") >= fallback, "llm_fallback").otherwise("review_required")
    return out.withColumn("prototype_route", route)


def evaluate(routed: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, mean similarity and counts by route; by ``keys``, or in all."""
    hit = (F.col("true_topic") == F.col("prototype_topic")).cast("double")
    return routed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.avg(hit).alias("accuracy"),
        F.avg("similarity").alias("avg_similarity"),
        *[F.count_if(F.col("prototype_route") == r).alias(f"{r}_cnt") for r in ("auto_accept", "llm_fallback", "review_required")],
    )


def confusion(routed: DataFrame) -> DataFrame:
    return routed.groupBy(*GROUP, "true_topic", "prototype_topic").agg(F.count(F.lit(1)).alias("row_cnt"), F.avg("similarity").alias("avg_similarity"))


def topic_similarity(df: DataFrame, per_topic: int = 20, seed: str = "42") -> DataFrame:
    """Similarity of pairs of memos of a group within a topic and between topics: count, mean, median.

    At most ``per_topic`` memos of each topic by hash, which bounds the pairs of a topic; this is the report's
    own sample, as it is in the batch it describes.
    """
    some = first_by(df, list(TOPIC), [sampling_key("memo_id", F.lit(seed)), F.asc("memo_id")], per_topic).select(*GROUP, *VERSION, "embedding_model", "memo_id", "pred_topic", unit(F.col("embedding")).alias("v"))
    keys = [*GROUP, *VERSION, "embedding_model"]
    a, b = (some.select(*keys, F.col("memo_id").alias(f"m{x}"), F.col("pred_topic").alias(f"t{x}"), F.col("v").alias(f"v{x}")) for x in "ab")
    pairs = a.join(b, keys).where("ma < mb").withColumn("similarity", dot(F.col("va"), F.col("vb"))).where("similarity is not null")
    kind = F.when(F.col("ta") == F.col("tb"), "intra").otherwise("inter").alias("pair_type")
    return pairs.groupBy(*GROUP, kind).agg(F.count(F.lit(1)).alias("pair_cnt"), F.avg("similarity").alias("avg_similarity"), F.percentile("similarity", 0.5).alias("median_similarity"))

