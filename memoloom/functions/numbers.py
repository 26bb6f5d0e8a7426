"""Guarded ratios and vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where there is no whole (ANSI mode would raise)."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    """Sum of products in the order of the elements; null where lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """A vector of length one; null elements for a vector of zeros."""
    n = F.array(F.nullif(norm(a), F.lit(0.0)))  # in an array of one, so that it is computed once
    return F.element_at(F.transform(n, lambda k: F.transform(a, lambda x: x.cast("double") / k)), 1)


def without_nan(df):
    """NaN in columns of doubles is null: a score that couldn't be computed isn't one that is larger than all others."""
    return df.withColumns({f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast("double")) for f in df.schema if f.dataType.simpleString() == "double"})
