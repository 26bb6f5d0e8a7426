"""Records that differ in format alone: one record each, with its number of copies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, col, cut, fields, fold

#: Copies of one text that a task compares with their first.
SPLIT = 20_000
_KEY = T.StructType([T.StructField(c, T.IntegerType() if c in "nk" else T.LongType()) for c in ("n", "s1", "s2", "k", "m1", "m2")])
_TOP, _MASK = 1 << 63, (1 << 64) - 1


def _signed(x: int) -> int:
    x &= _MASK
    return x - (1 << 64) if x >= _TOP else x


def text_key(text: str) -> tuple[int, int, int, int, int, int]:
    """Letters and digits; two hashes of their sequence; fields; two commutative hashes of the fields.

    Each field's label and value are hashed together; the hashes of a record are added, so neither the
    order of the fields nor a sort plays a part, and repeated fields count.
    """
    seq = "".join(WORD.findall(fold(text)))
    h = xxhash.xxh3_128_intdigest(seq)
    parts = fields(text)
    if parts is None:
        return len(seq), _signed(h), _signed(h >> 64), 0, 0, 0
    m1 = m2 = 0
    for p in parts:
        f = xxhash.xxh3_128_intdigest(p)
        m1, m2 = m1 + (f & _MASK), m2 + (f >> 64)
    return len(seq), _signed(h), _signed(h >> 64), len(parts), _signed(m1), _signed(m2)


@F.pandas_udf(_KEY)
def text_keys(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_key(t or "") for t in texts], columns=["n", "s1", "s2", "k", "m1", "m2"])


def same_text(a: str, b: str) -> bool:
    """Equal letters and digits in sequence or, of two field lists, equal fields in any order."""
    if "".join(WORD.findall(fold(a))) == "".join(WORD.findall(fold(b))):
        return True
    x, y = fields(a), fields(b)
    if x is None or y is None or len(x) != len(y):
        return False
    left: dict[str, int] = {}
    for f in x:
        left[f] = left.get(f, 0) + 1
    for f in y:
        if not left.get(f):
            return False
        left[f] -= 1
    return True


def _holds(a: str, b: str) -> bool:
    """Whether a pair of one class stands: same text, or linked by a third (no key in common)."""
    if same_text(a, b):
        return True
    x, y = text_key(a), text_key(b)
    return x[1:3] != y[1:3] and not (x[3] and x[3:] == y[3:])


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["same"] = [_holds(x, y) for x, y in zip(b["text"], b["first_text"])]
        yield b[["first_id", "id", "same"]]


def format_copies(df: DataFrame, group_cols: list[str], id_col: str, text_col: str, min_length: int = 20) -> DataFrame:
    """Members of each class of the same text within a group: ``first_id`` and ``copy_id``.

    The same text: equal letters and digits in sequence, ignoring case, white space, punctuation, signs,
    invisible characters and how accents are composed; of records that both consist of three or more
    ``label: value`` fields, the order of the fields is ignored too. The two relations may chain (a field
    list, and the same letters without its separators); chains make one class.

    Texts of fewer than ``min_length`` letters and digits, nulls among them, are in no class. Null group
    columns equal null. ``first_id`` is the smallest id of its class and is no copy itself; rows written
    again under other ids are copies; a row repeated with its id is one row. Each copy is compared with the
    text of its first by the fields themselves, not by hashes alone. An empty table gives an empty result;
    columns that aren't named are ignored.
    """
    keys = [f"_g{i}" for i in range(len(group_cols))]
    rows = df.where(col(text_col).isNotNull() & (F.length(col(text_col)) >= min_length)).select(
        col(id_col).alias("id"), F.xxhash64(*[x for g in group_cols for x in (col(g).isNull(), col(g))]).alias("g1"), F.hash(*[col(g) for g in group_cols]).alias("g2"), text_keys(col(text_col)).alias("key")
    )
    rows = cut(rows.select("id", "g1", "g2", "key.*").where(F.col("n") >= min_length))
    seq, group = ["s1", "s2"], ["g1", "g2"]

    # A sequence that field lists have takes their class; that of plain texts is their own.
    listed = rows.where("k > 0").select(*group, *seq, F.struct("m1", "m2").alias("m")).distinct()
    of_seq = listed.groupBy(*group, *seq).agg(F.min("m").alias("c"), F.count(F.lit(1)).alias("ways"))
    of_list = listed.select(*group, "m").distinct().withColumn("c", F.col("m"))
    if not of_seq.where("ways > 1").isEmpty():  # fields split in different ways, same letters: follow the chains
        while True:
            step = listed.join(of_list, [*group, "m"]).groupBy(*group, *seq).agg(F.min("c").alias("c"), F.lit(2).alias("ways"))
            after = cut(listed.join(step, [*group, *seq]).groupBy(*group, "m").agg(F.min("c").alias("c2")).join(of_list, [*group, "m"]).select(*group, "m", F.least("c", "c2").alias("c"), (F.col("c2") < F.col("c")).alias("moved")))
            of_seq, of_list, moved = step, after.drop("moved"), after.where("moved")
            if moved.isEmpty():
                break
    own = F.struct(F.col("s1").alias("m1"), F.col("s2").alias("m2"))
    classes = rows.join(of_seq, [*group, *seq], "left").select("id", *group, F.coalesce("c", own).alias("c"))
    sets = classes.groupBy(*group, "c").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n")).where("first_id < last_id")
    pairs = cut(classes.join(sets, [*group, "c"]).where("id > first_id").select("first_id", "id", F.ceil(F.col("n") / SPLIT).cast("int").alias("splits")).distinct())

    # The texts themselves decide, but for pairs that hang together by a third alone. The first of very many copies
    # meets them in several tasks.
    needed = pairs.select("id").unionAll(pairs.select("first_id")).distinct()
    texts = cut(df.where(col(text_col).isNotNull()).select(col(id_col).alias("id"), col(text_col).alias("text")).join(needed, "id").distinct())
    firsts = pairs.groupBy("first_id").agg(F.max("splits").alias("splits")).join(texts.select(F.col("id").alias("first_id"), F.col("text").alias("first_text")), "first_id")
    firsts = firsts.select("first_id", "first_text", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"))
    copies = pairs.join(texts, "id").withColumn("split", F.pmod(F.xxhash64("id"), F.col("splits")).cast("int"))
    checked = copies.join(firsts, ["first_id", "split"]).select("first_id", "id", "text", "first_text").mapInPandas(_verify, "first_id long, id long, same boolean")
    return checked.where("same").select("first_id", F.col("id").alias("copy_id")).distinct()
