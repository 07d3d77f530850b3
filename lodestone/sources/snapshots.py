"""Snapshots of a versioned table: create, list, preview, restore, retire, retention."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.tables import active, restore_merge, union_like
from lodestone.operators.window import top_k
from lodestone.sources.catalog import SNAPSHOT_META
from lodestone.sources.versioned import VersionedTable


def retire_old(meta: DataFrame, keep: int = 10) -> DataFrame:
    """Flag all but the ``keep`` newest active snapshots as deleted, in one statement. The
    newest ones come from a top-k, not from a global sort."""
    live = meta.filter(F.col("status") == "ACTIVE")
    kept = (top_k(live, [F.desc("created_at"), F.desc("table_version")], keep)
            .select(F.col("backup_id").alias("_kept")))
    marked = meta.join(kept, F.col("backup_id") == F.col("_kept"), "left")
    gone = (F.col("status") == "ACTIVE") & F.col("_kept").isNull()
    return (marked.withColumn("status", F.when(gone, F.lit("DELETED")).otherwise(F.col("status")))
            .drop("_kept"))


class SnapshotStore:
    """Snapshots of ``table`` below ``root``. Files of retired snapshots are kept."""

    def __init__(self, table: VersionedTable, root: str, keep: int = 10):
        self.table = table
        self.spark = table.spark
        self.root = root.rstrip("/")
        self.meta = VersionedTable(self.spark, f"{self.root}/_meta")
        self.keep = keep

    def _metadata(self) -> DataFrame:
        if self.meta.exists():
            return self.meta.read()
        return self.spark.createDataFrame([], SNAPSHOT_META)

    def create(self, name: str = "", description: str = "", include_deleted: bool = False) -> str:
        """Snapshot the active rows (all rows on request) and apply the retention rule."""
        now = datetime.now(timezone.utc)
        snapshot_id = uuid.uuid4().hex[:12].upper()
        path = f"{self.root}/{snapshot_id}"
        rows = self.table.read()
        if not include_deleted and "is_deleted" in rows.columns:
            rows = active(rows)
        rows.write.mode("errorifexists").parquet(path, compression="snappy")
        # Counted from the footers of what was written, not by running the table's plan again.
        count = self.spark.read.parquet(path).count()
        meta = self._metadata()
        version = (meta.agg(F.max("table_version")).first()[0] or 0) + 1
        row = self.spark.createDataFrame(
            [(snapshot_id, name or f"SNAPSHOT_{now:%Y%m%d_%H%M%S}", path, count, version,
              description, "ACTIVE", now)], SNAPSHOT_META)
        self.meta.replace(retire_old(meta.unionByName(row), self.keep).coalesce(1))
        return snapshot_id

    def list(self) -> DataFrame:
        """Active snapshots, newest first."""
        return (self._metadata().filter(F.col("status") == "ACTIVE")
                .orderBy(F.desc("created_at"), F.desc("table_version")))

    def rows(self, snapshot_id: str) -> DataFrame:
        """The rows of an active snapshot."""
        found = (self._metadata().filter((F.col("backup_id") == snapshot_id)
                                         & (F.col("status") == "ACTIVE"))
                 .select("backup_path").first())
        if found is None:
            raise ValueError(f"no active snapshot {snapshot_id}")
        return self.spark.read.parquet(found[0])

    def preview(self, snapshot_id: str, n: int = 20) -> DataFrame:
        return self.rows(snapshot_id).limit(n)

    def restore(self, snapshot_id: str, mode: str = "replace", key: str = "id") -> int:
        """Bring a snapshot back; the new table version is returned.

        ``replace`` snapshots the current rows first and then swaps; ``merge`` adds unknown ids
        (soft-deleted ids are known); ``append`` adds every row.
        """
        rows = self.rows(snapshot_id)
        if mode == "replace":
            self.create(f"AUTO_PRE_RESTORE_{snapshot_id}", f"before restoring {snapshot_id}")
            return self.table.replace(rows)
        current = self.table.read()
        if mode == "merge":
            return self.table.replace(restore_merge(current, rows, key))
        if mode == "append":
            return self.table.replace(union_like(current, rows))
        raise ValueError(f"unknown restore mode {mode!r}")

    def retire(self, snapshot_id: str) -> None:
        """Flag one snapshot as deleted."""
        gone = F.col("backup_id") == snapshot_id
        status = F.when(gone, F.lit("DELETED")).otherwise(F.col("status"))
        self.meta.replace(self._metadata().withColumn("status", status).coalesce(1))
