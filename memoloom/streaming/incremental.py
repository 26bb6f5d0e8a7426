"""Classification of arriving files (an extension): each micro-batch replaces its own keys, so it may run twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import GROUP, with_memo_id
from ..operators.classify import classify
from ..operators.sampling import dedupe_for_classification
from ..sources.registry import eligible
from ..sources.store import Store


def classify_stream(spark: SparkSession, folder: str, schema: T.StructType, profile: DataFrame, topic: DataFrame, store: Store, checkpoint: str, table: str = "classification_stream"):
    """Starts a query that classifies new parquet files of ``folder`` into ``table``, all that are there and no more."""

    def batch(df: DataFrame, batch_id: int) -> None:
        memos = dedupe_for_classification(with_memo_id(eligible(df)))
        store.write(table, classify(memos, profile, topic).withColumn("batch_id", F.lit(batch_id)), "replace", (*GROUP, "memo_id"))

    source = spark.readStream.schema(schema).parquet(folder)
    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

