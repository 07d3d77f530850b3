"""Parquet tables dealt by a hash of their key: a change reads and writes only the parts it touches.

The rows lie in ``buckets`` partitions of Spark's own directory layout. A batch of keys names its
partitions; reads prune to them, inserts append to them, and updates and deletions replace them by
dynamic partition overwrite. All other files stay as they are.

Partitions are replaced one after another when the job commits. A change that broke off there is made
whole by running it again: every change here gives the same table when it is repeated. One writer at
a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.tables import hard_delete, soft_delete, unseen_rows, upsert
from lodestone.sources.versioned import VersionedTable

# Bits of a long that hold one mark each.
_MARKS = 62


class KeyedTable:
    """A table with unique non-null ``key``s; ``buckets`` is fixed when it is first written."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key
        self.buckets = buckets
        self._part = f"_{key}_of_{buckets}"
        other = [n for n in self._listed() if n.partition("=")[0] != self._part]
        if other:
            raise ValueError(f"{root} is dealt otherwise: {other[0]}")

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self) -> list[str]:
        root, fs = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return [n for n in names if re.fullmatch(r"_.*_of_\d+=\d+", n)]

    def exists(self) -> bool:
        return bool(self._listed())

    def bucket(self) -> Column:
        """The partition of a row; the key's text is hashed, so its numeric type does not matter."""
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Partitions of the keys of ``rows``."""
        found = rows.filter(F.col(self.key).isNotNull()).select(self.bucket().alias("b")).distinct()
        return sorted(r["b"] for r in found.collect())

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The whole table, or the named partitions only."""
        rows = self.spark.read.parquet(self.root)
        if buckets is not None:
            rows = rows.filter(F.col(self._part).isin(*buckets))
        return rows.drop(self._part)

    def _dealt(self, rows: DataFrame, parts: int) -> DataFrame:
        return rows.withColumn(self._part, self.bucket()).repartition(max(1, parts), self._part)

    def _write(self, dealt: DataFrame, mode: str) -> None:
        (dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(self._part).parquet(self.root, compression="snappy"))

    def create(self, rows: DataFrame) -> None:
        """Write a new table; rows without a key are left out."""
        if self.exists():
            raise ValueError(f"{self.root} exists")
        self._write(self._dealt(rows.filter(F.col(self.key).isNotNull()), self.buckets), "append")

    def insert_new(self, rows: DataFrame) -> None:
        """Append the rows whose key is not in the table, one per key. Only the keys of the touched
        partitions are read, nothing is rewritten, and running it again adds nothing."""
        if not self.exists():
            self.create(rows.dropDuplicates([self.key]))
            return
        touched = self.touched(rows)
        if touched:
            fresh = unseen_rows(self.read(touched), rows, self.key)
            fields = self.read().schema.fields
            shaped = [F.col(f.name) if f.name in fresh.columns
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
            self._write(self._dealt(fresh.select(*shaped), len(touched)), "append")

    def change(self, keys: DataFrame, new: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the partitions that hold ``keys`` by ``new`` of their rows; gives the partitions."""
        touched = self.touched(keys)
        if touched:
            columns = self.read().columns
            self._replace(touched, new(self.read(touched)).select(*columns))
        return touched

    def _replace(self, touched: list[int], rows: DataFrame) -> None:
        dealt = self._dealt(rows, len(touched))
        part, groups = F.col(self._part), -(-self.buckets // _MARKS)
        marks = [F.bit_or(F.when(F.floor(part / _MARKS) == g, F.call_function(
            "shiftleft", F.lit(1).cast("long"), (part % _MARKS).cast("int"))))
            .alias(f"m{g}") for g in range(groups)]
        kept = Observation()
        self._write(dealt.observe(kept, *marks), "overwrite")
        found = kept.get
        root, fs = self._fs()
        for b in touched:  # a partition without rows is not written, so not replaced
            if not (found.get(f"m{b // _MARKS}") or 0) >> (b % _MARKS) & 1:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(root, f"{self._part}={b}"), True)

    def upsert(self, changes: DataFrame, **options) -> list[int]:
        """:func:`lodestone.operators.tables.upsert` on the touched partitions."""
        return self.change(changes, lambda part: upsert(part, changes, self.key, **options))

    def hard_delete(self, keys: DataFrame) -> list[int]:
        return self.change(keys, lambda part: hard_delete(part, keys, self.key))

    def soft_delete(self, keys: DataFrame, reason: str, audit: VersionedTable,
                    now: Column | None = None) -> list[int]:
        """Flag the rows and append them to ``audit``, which comes first: if the change breaks off
        between the two, running it again audits the rows once more."""
        touched = self.touched(keys)
        if touched:
            columns = self.read().columns
            flagged, gone = soft_delete(self.read(touched), keys, self.key, reason, now)
            audit.append(gone)
            self._replace(touched, flagged.select(*columns))
        return touched

    def compact(self, files: int = 8) -> list[int]:
        """Rewrite the partitions that consist of more than ``files`` files as one file each."""
        root, fs = self._fs()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        many = sorted(int(n.partition("=")[2]) for n in self._listed()
                      if len(fs.listStatus(path(root, n))) > files)
        if many:
            self._replace(many, self.read(many))
        return many
