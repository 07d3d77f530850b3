"""Parquet tables whose whole contents can be replaced safely while being read.

Version ``n`` of a table is the folder ``v<n>`` below its root, together with the folders ``v<n>.<k>``
of rows appended to it. Spark writes ``_SUCCESS`` into a folder when its job commits, so the newest
folder with that marker is the current version and a failed or interrupted write, of a version or
of appended rows, is never seen. One writer at a time; readers need no lock.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _listed(self) -> list[tuple[int, int, bool]]:
        """(version, number of the append or 0, committed) of every folder."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            match = re.fullmatch(r"v(\d+)(?:\.(\d+))?", status.getPath().getName())
            if match:
                done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
                found.append((int(match.group(1)), int(match.group(2) or 0),
                              bool(fs.exists(done))))
        return sorted(found)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v, k, done in self._listed() if done and not k]

    def paths(self, version: int | None = None) -> list[str]:
        """The committed folders of a version (the newest one): itself and its appended rows."""
        if version is None:
            committed = self.versions()
            if not committed:
                raise ValueError(f"no committed version below {self.root}")
            version = committed[-1]
        return [f"{self.root}/v{version}" + (f".{k}" if k else "")
                for v, k, done in self._listed() if v == version and done]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(*self.paths(version))

    def replace(self, df: DataFrame) -> int:
        """Write ``df``, which may read this table, as the next version."""
        version = max((v for v, *_ in self._listed()), default=0) + 1
        df.write.mode("errorifexists").parquet(f"{self.root}/v{version}", compression="snappy")
        return version

    def append(self, df: DataFrame) -> None:
        """Add rows to the current version without rewriting it, all or none of them. ``df`` may
        read this table: the folders to read are listed before the new one appears."""
        if not self.exists():
            self.replace(df)
            return
        version = self.versions()[-1]
        number = max(k for v, k, _ in self._listed() if v == version) + 1
        df.select(*self.read().columns).write.mode("errorifexists").parquet(
            f"{self.root}/v{version}.{number}", compression="snappy")
