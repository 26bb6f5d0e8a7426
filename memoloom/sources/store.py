"""Parquet tables that can be replaced by key: every change is a new version, made visible by one rename.

A version is a list of folders of parquet files, its parts; a small file names the current version and those before
it that are kept. An append adds a part to the list, so that it shows as a whole or not at all; other changes write
one new part. Readers of an older version keep it while it is kept; a writer may read the table that it replaces.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform

MODES = ("overwrite", "append", "replace")
MOST_PARTS = 64


class Store:
    def __init__(self, spark: SparkSession, folder: str, keep_versions: int = 2):
        self.spark, self.folder, self.keep = spark, folder.rstrip("/"), keep_versions
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[list[str]]:
        """The parts of the current version, then of those before it; none if there is no table."""
        pointer = self._path(f"{self.folder}/{name}/_current")
        if not self._fs.exists(pointer):
            return []
        stream = self._fs.open(pointer)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def read(self, name: str) -> DataFrame:
        """The current version; parts that were appended with more columns merge by name."""
        if not (versions := self._versions(name)):
            raise KeyError(f"no table {name!r} in {self.folder}")
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.folder}/{name}/{p}" for p in versions[0]])

    def create(self, name: str, schema: T.StructType) -> None:
        """Makes an empty table unless it is there."""
        if not self.exists(name):
            self._swap(name, self.spark.createDataFrame([], schema))

    def _swap(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), beside: list[str] | None = None) -> None:
        """Writes a part and makes it, with the parts ``beside`` it, the current version."""
        part, old = uuid.uuid4().hex, self._versions(name)
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{self.folder}/{name}/{part}")
        versions = [[*(beside or []), part], *old][: self.keep]
        temporary = self._path(f"{self.folder}/{name}/_next_{part}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps(versions).encode()))
        out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(temporary, self._path(f"{self.folder}/{name}/_current"), options)
        kept = {p for v in versions for p in v}
        for gone in {p for v in old for p in v} - kept:  # parts of the oldest version, which no kept one has
            self._fs.delete(self._path(f"{self.folder}/{name}/{gone}"), True)

    def write(self, name: str, df: DataFrame, mode: str = "append", keys: tuple[str, ...] = (), schema: T.StructType | None = None, partition_by: tuple[str, ...] = ()) -> None:
        """overwrite: as it is. append: adds a part, with new columns if it has any; makes the table if absent.
        replace: rows whose ``keys`` occur in ``df`` (nulls equal nulls) go, then ``df`` comes."""
        if mode not in MODES:
            raise ValueError(f"write mode {mode!r} is none of {MODES}")
        new = conform(df, schema) if schema is not None else df
        if mode == "overwrite" or not self.exists(name):
            self._swap(name, new, partition_by)
        elif mode == "append":
            parts = self._versions(name)[0]
            if len(parts) < MOST_PARTS:
                self._swap(name, new, partition_by, parts)
            else:  # many small parts become one
                self._swap(name, self.read(name).unionByName(new, allowMissingColumns=True), partition_by)
        else:
            if not keys:
                raise ValueError("replace needs keys")
            self._swap(name, replaced(self.read(name), new, keys), partition_by)

    def delete(self, name: str, condition: Column) -> None:
        """Rows for which the condition holds go; those for which it is null stay."""
        self._swap(name, self.read(name).where(~F.coalesce(condition, F.lit(False))))

    def update(self, name: str, condition: Column, values: dict[str, Column | str | None]) -> None:
        old = self.read(name)
        hit = F.coalesce(condition, F.lit(False))
        new = {c: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(old.schema[c].dataType) for c, v in values.items()}
        self._swap(name, old.withColumns(new))


def replaced(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``old`` without the rows whose keys occur in ``new``, and ``new``. Keys compare nulls as equal."""
    seen = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    on = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = same if on is None else on & same
    return old.join(seen, on, "left_anti").unionByName(new, allowMissingColumns=True)
