"""The queries of the operators of this subpackage, and their equivalents in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import abuse
from .clusters import clusters, described
from .common import cut, table
from .copies import format_copies
from .language import languages
from .leakage import SPAN, leaks
from .neardup import expand, near_groups, near_pairs
from .neighbours import nearest, with_ids
from .sampling import sample_to_targets
from .tokens import encode_texts, token_counts
from .topn import top_n
from .vectors import Vectors, load

GROUP = ["cate_1_depth", "cate_2_depth", "sc_measurement"]


def _p1(spark: SparkSession, d: str, count_observed: bool = False) -> tuple[DataFrame, DataFrame]:
    return sample_to_targets(table(spark, d, "classification_detail"), table(spark, d, "sample_target"), GROUP, "memo_id", "memo", "detail_id", count_observed=count_observed)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _p1(spark, d)[1].where("deficit > 0").select(*GROUP)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return _p1(spark, d, True)[1].select(*GROUP, "needed", "observed", "drawn", "deficit")


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return _p1(spark, d)[0]


def _p2(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return near_pairs(table(spark, d, "classification_detail"), "detail_id", "memo")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return expand(*_p2(spark, d)).select("id_a", "id_b")


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    pairs, members = _p2(spark, d)
    return near_groups(cut(pairs), members)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return format_copies(table(spark, d, "classification_detail"), GROUP, "detail_id", "memo")


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("first_id").agg((F.count(F.lit(1)) + 1).alias("copies"))


def _vectors(spark: SparkSession, d: str) -> Vectors:
    return load(table(spark, d, "memo_embedding"), "memo_id", "embedding", 64, "embedding_model", "stub-encoder-64")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    members, _ = clusters(_vectors(spark, d))
    return members.where("vid > cluster").select("first_id", F.col("id").alias("memo_id"))


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    members, assigned = clusters(_vectors(spark, d))
    topics = table(spark, d, "memo_embedding").select(F.col("memo_id").alias("id"), F.col("pred_topic").alias("topic"))
    return described(members, assigned, topics)


def _p5(spark: SparkSession, d: str) -> DataFrame:
    return languages(table(spark, d, "classification_detail"), "detail_id", "memo", "country", table(spark, d, "country_language"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _p5(spark, d).where("seg_no > 0 or not fits").select("detail_id", "seg_no", "lang")


def p5_languages(spark: SparkSession, d: str) -> DataFrame:
    return _p5(spark, d)


def _p6(spark: SparkSession, d: str) -> DataFrame:
    return top_n(table(spark, d, "classification_detail"), ["cate_2_depth", "pred_topic"], "confidence_score", "detail_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d).select("cate_2_depth", "pred_topic", "detail_id")


def p6_ranked(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d)


def _p7(spark: SparkSession, d: str, least: float) -> DataFrame:
    vectors = _vectors(spark, d)
    return with_ids(vectors, nearest(vectors, 5, least))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d, 0.8).select(F.least("id", "neighbour_id").alias("id_a"), F.greatest("id", "neighbour_id").alias("id_b")).distinct()


def p7_nearest(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d, -1.0)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(p8_ids(spark, d), "doc_id")


def _p9(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d).where(F.col("exact_words") >= SPAN).select("doc_id", "item_id")


def p9_near(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d)


def _p10(spark: SparkSession, d: str) -> DataFrame:
    return abuse.content_scores(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "content_label"), "doc_id", ("source",))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse.found(_p10(spark, d), "doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _p10(spark, d).select("doc_id", *abuse.KINDS)


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(_p10(spark, d), "source")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        p1_found, p1_report, p1_sample, p2_found, p2_groups, p3_found, p3_counts, p4_found, p4_clusters, p5_found, p5_languages, p6_found, p6_ranked, p7_found, p7_nearest, p8_ids, p8_counts, p9_found, p9_near, p10_found, p10_scores, p10_rates,
    )}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return SQL
