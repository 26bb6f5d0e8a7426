"""The best rows of every group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col


def top_n(df: DataFrame, group_cols: list[str], score_col: str, id_col: str, n: int = 5) -> DataFrame:
    """The ``n`` rows of the highest score in each group; ties go to the smaller id.

    Rows with a null in a group column, the score or the id, or with a NaN score, don't count; infinite
    scores do. Repeated rows count on their own. ``row_number() <= n`` over a partitioned window lets Spark
    put a group limit before the shuffle and another after it, so a group of any size arrives as at most
    ``n`` rows from each task. Strings compare exactly. An empty table gives an empty result. Returns the
    group columns, the id, the score and ``rank``; other columns are neither read nor returned.
    """
    keys = [f"_g{i}" for i in range(len(group_cols))]
    rows = df.select(*[col(g).alias(k) for g, k in zip(group_cols, keys)], col(id_col).alias("_id"), col(score_col).cast("double").alias("_score"))
    for c in (*keys, "_id", "_score"):
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.where(~F.isnan("_score"))
    order = Window.partitionBy(*keys).orderBy(F.desc("_score"), F.asc("_id"))
    best = rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return best.select(*[F.col(k).alias(g) for g, k in zip(group_cols, keys)], F.col("_id").alias(id_col), F.col("_score").alias(score_col), F.col("_rank").alias("rank"))
