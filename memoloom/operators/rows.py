"""One row of each key by a total order; anti-join increments; set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import GROUP


def first_by(df: DataFrame, keys: list[str] | tuple[str, ...], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key. ``order`` should be total; group limits prune before the shuffle."""
    name = rank or "_rn"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest(df: DataFrame, keys: list[str] | tuple[str, ...], by: list[str] | tuple[str, ...], tie: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each key: ``by`` descending with nulls last, then ``tie`` ascending."""
    return first_by(df, keys, [F.desc_nulls_last(c) for c in by] + [F.asc_nulls_last(c) for c in tie])


def increment(new: DataFrame, done: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows whose keys aren't among those done; a row with a null key counts as new."""
    return new.join(done.select(*keys).distinct(), list(keys), "left_anti")


def total_over(df: DataFrame, keys: list[str] | tuple[str, ...], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same keys (all rows, if there are none)."""
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys)))


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def at_most(df: DataFrame, n: int) -> bool:
    """Whether there are no more than ``n`` rows, found by reading no more than that."""
    return df.limit(n + 1).count() <= n


def to_groups(df: DataFrame, groups: DataFrame, how: str = "inner", most: int = 20_000) -> DataFrame:
    """``df`` with the row of its group, of which ``groups`` has one each; null groups don't match.

    Up to ``most`` groups are sent to the rows, so that a group of any size stays where it is. More are joined by
    group, where Spark divides a large one as it runs.
    """
    few = at_most(groups.select(*GROUP), most)  # keys alone, so that nothing else of the groups is computed for it
    return df.join(F.broadcast(groups) if few else groups, list(GROUP), how)


def matching(df: DataFrame, equal: dict | None = None, contains: dict | None = None) -> DataFrame:
    """Rows of a listing under its filters: columns that equal a value and columns that hold a text, without case.

    None and blank values don't filter.
    """
    for c, v in (equal or {}).items():
        if v is not None and str(v).strip():
            df = df.where(F.col(c).cast("string") == str(v))
    for c, v in (contains or {}).items():
        if v is not None and str(v).strip():
            df = df.where(F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(str(v).strip().lower())))
    return df


def counted(df: DataFrame, condition: Column) -> DataFrame:
    """One row: how many rows there are, and how many of them the condition holds for, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("all_cnt"), F.count_if(condition).alias("filtered_cnt"))
