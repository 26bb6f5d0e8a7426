"""Tables by logical key, and scans of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import without_nan

BLANK = ("", "none", "null", "*")


@dataclass
class Registry:
    """Logical key to the path of a parquet table or, with a name after ``table:``, to one of the catalog."""

    spark: SparkSession
    places: dict[str, str] = field(default_factory=dict)
    _read: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    @classmethod
    def of_folder(cls, spark: SparkSession, folder: str, names: list[str] | tuple[str, ...]) -> Registry:
        return cls(spark, {n: f"{folder}/{n}.parquet" for n in names})

    def place(self, key: str) -> str:
        try:
            return self.places[key]
        except KeyError:
            raise KeyError(f"no table is registered as {key!r}; known: {sorted(self.places)}") from None

    def exists(self, key: str) -> bool:
        place = self.place(key)
        if place.startswith("table:"):
            return self.spark.catalog.tableExists(place[6:])
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def read(self, key: str) -> DataFrame:
        """The table, as it was found first; NaN in its columns of doubles is null from here on."""
        if key not in self._read:
            place = self.place(key)
            self._read[key] = without_nan(self.spark.table(place[6:]) if place.startswith("table:") else self.spark.read.parquet(place))
        return self._read[key]

    def scan(self, key: str, filters: dict | None = None, snippets: tuple[str, ...] = ()) -> DataFrame:
        """A table under equality filters (None: no filter) and configured predicates, all of which push down."""
        df = self.read(key)
        for c, v in (filters or {}).items():
            if v is not None:
                df = df.where(F.col(c) == v)
        for s in snippets:
            df = df.where(F.expr(s))
        return df


def has_text(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return x.isNotNull() & (F.length(F.trim(x)) > 0)


def eligible(df: DataFrame, excluded_prefix: str = "***", sentiments: tuple[int, ...] = (1, -1), group: dict | None = None, snippets: tuple[str, ...] = ()) -> DataFrame:
    """Reviews of regular categories with one of the sentiments and a memo that isn't blank."""
    out = df.where(~F.coalesce(F.startswith("cate_2_depth", F.lit(excluded_prefix)), F.lit(False)) & ~F.coalesce(F.startswith("cate_1_depth", F.lit(excluded_prefix)), F.lit(False)))
    out = out.where(F.col("sc_measurement").isin(*sentiments) & has_text("memo"))
    for c, v in (group or {}).items():
        if v is not None and str(v).strip().lower() not in BLANK:
            out = out.where(F.col(c) == v)
    for s in snippets:
        out = out.where(F.expr(s))
    return out
