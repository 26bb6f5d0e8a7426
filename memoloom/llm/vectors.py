"""Usable vectors, numbered in the order of their ids, and their moments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, cut


@dataclass
class Vectors:
    """``rows``: vid, id, vec (float32 of unit length); vid rises with the id. ``n`` rows of ``dim`` elements."""

    rows: DataFrame
    n: int
    dim: int
    mean: np.ndarray
    cov: np.ndarray


def usable(df: DataFrame, id_col: str, vector_col: str, dim: int, model_col: str | None = None, model: str | None = None) -> DataFrame:
    """``id`` and ``vec`` of rows with an id and ``dim`` elements, none null, NaN or infinite and not all zero.

    Of repeated rows of an id one stays; they are meant to carry the same vector (if not, the smallest).
    """
    v = col(vector_col)
    ok = (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    if model_col:
        ok = (col(model_col) == model) & ok
    rows = df.where(F.coalesce(ok, F.lit(False)) & col(id_col).isNotNull()).select(col(id_col).alias("id"), v.cast("array<float>").alias("vec"))
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))
    x /= np.abs(x).max(1, keepdims=True).clip(1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def load(df: DataFrame, id_col: str, vector_col: str, dim: int, model_col: str | None = None, model: str | None = None) -> Vectors:
    """Numbers the usable vectors by the order of their ids and takes their moments, over all of them."""
    rows = cut(usable(df, id_col, vector_col, dim, model_col, model).orderBy("id").withColumn("vid", F.monotonically_increasing_id()).select("vid", "id", "vec"))

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, ss = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = matrix(b["vec"])
            if len(x):
                n, s, ss = n + len(x), s + x.sum(0), ss + x.T @ x
        v = np.concatenate([[n], s, ss[np.triu_indices(dim)]])
        yield pd.DataFrame({"k": np.arange(len(v), dtype=np.int32), "v": v})

    got = rows.select("vec").mapInPandas(moments, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")["v"].to_numpy()
    n = int(got[0]) if len(got) else 0
    if not n:
        return Vectors(rows, 0, dim, np.zeros(dim), np.eye(dim))
    mean = got[1 : dim + 1] / n
    second = np.zeros((dim, dim))
    second[np.triu_indices(dim)] = got[dim + 1 :] / n
    second = np.triu(second) + np.triu(second, 1).T
    return Vectors(rows, n, dim, mean, second - np.outer(mean, mean))
