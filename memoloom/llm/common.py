"""What the operators of this subpackage share: loading, lineage cuts, text folding and hashing."""

from __future__ import annotations

import atexit
import re
import shutil
import sys
import tempfile
import unicodedata

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage of ``df`` with a reliable checkpoint.

    The folder is that of ``spark.checkpoint.dir``, which the executors share. Where the session names none, a
    session whose tasks run in the driver's process (tests, notebooks) gets a temporary folder that goes with the
    process; on a cluster a folder of one machine would be no use, so there it is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="memoloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint()


def drop(df: DataFrame) -> None:
    """Deletes the files of a frame that :func:`cut` returned and that nothing will read again."""
    spark = df.sparkSession
    try:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    except Exception:  # not a checkpointed frame, so there is nothing to delete  # noqa: BLE001
        return
    if file.isDefined():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def is_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows, found by reading no more than that."""
    return df.limit(rows + 1).count() <= rows


#: Characters that are invisible though Unicode calls them letters or marks.
_INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))


def _ranges() -> str:
    points = sorted({*map(ord, _INVISIBLE), *(c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf")})
    out, start = [], points[0]
    for a, b in zip(points, [*points[1:], -1]):
        if b != a + 1:
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(a))}")
            start = b
    return "[" + "".join(out) + "]"


_HIDDEN: re.Pattern | None = None
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Text without invisible characters, composed and without case; the dotless i counts as i."""
    global _HIDDEN
    if text.isascii():
        return text.lower()
    if _HIDDEN is None:
        _HIDDEN = re.compile(_ranges())
    text = unicodedata.normalize("NFC", _HIDDEN.sub("", text)).casefold()
    return unicodedata.normalize("NFC", text.replace("ı", "i").replace("i̇", "i"))


def words(text: str) -> list[str]:
    """Maximal runs of letters or digits, compared without case."""
    return WORD.findall(fold(text))


_FIELD_END = re.compile(r"[;|\r\n  \x85\x0b\x0c；｜]+")
_FIELD_MID = re.compile(r"[:=：＝]")


def letters(text: str) -> str:
    """The letters and digits of a text in sequence."""
    return "".join(WORD.findall(fold(text)))


def fields(text: str) -> list[str] | None:
    """Normalised ``label: value`` pairs, if the text consists of three or more of them."""
    if ":" not in text and "=" not in text and "：" not in text and "＝" not in text:
        return None
    out = []
    for part in _FIELD_END.split(text):
        if not (whole := letters(part)):
            continue
        label = _FIELD_MID.split(part, maxsplit=1)
        if len(label) < 2 or not (name := letters(label[0])) or len(name) == len(whole):
            return None
        out.append(name + "\x1f" + whole[len(name) :])
    return out if len(out) >= 3 else None


_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on unsigned 64-bit integers."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))
