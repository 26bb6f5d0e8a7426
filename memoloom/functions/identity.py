"""Content identity of a memo, surrogate keys and sampling keys; pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = "||"
GROUP = ("cate_1_depth", "cate_2_depth", "sc_measurement")
VERSION = ("prompt_version", "taxonomy_version", "model_version")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_or_empty(x: str | Column) -> Column:
    return F.coalesce(_c(x).cast("string"), F.lit(""))


def normalize_memo(memo: str | Column) -> Column:
    """Lower case; anything but ASCII letters, digits, Hangul syllables and spaces becomes one space; null is ''.

    Lossy for accented Latin and for scripts outside that range, which is part of the identity's contract.
    """
    spaced = F.translate(F.coalesce(_c(memo), F.lit("")), "　", " ")
    kept = F.regexp_replace(F.lower(spaced), r"[^0-9a-zA-Z가-힣\s]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def memo_id(norm: str | Column = "memo_norm", group: tuple[str | Column, ...] = GROUP) -> Column:
    """SHA-256 of the group and the normalised memo; null parts count as ''."""
    return surrogate_key(*group, norm)


def surrogate_key(*parts: str | Column) -> Column:
    return F.sha2(F.concat_ws(SEP, *[text_or_empty(p) for p in parts]), 256)


def sampling_key(*parts: str | Column) -> Column:
    """An order that looks random but is fixed by content: the MD5 of the parts."""
    return F.md5(F.concat_ws(SEP, *[text_or_empty(p) for p in parts]))


def with_memo_id(df: DataFrame, memo: str = "memo", group: tuple[str, ...] = GROUP) -> DataFrame:
    """Adds ``memo_norm`` and ``memo_id`` where absent; those present stay."""
    if "memo_norm" not in df.columns:
        df = df.withColumn("memo_norm", normalize_memo(memo))
    if "memo_id" not in df.columns:
        df = df.withColumn("memo_id", memo_id("memo_norm", group))
    return df
