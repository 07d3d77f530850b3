"""Set-based table maintenance: every change is a DataFrame of keys or rows, never a loop.

The functions return the new contents; :class:`lodestone.sources.versioned.VersionedTable`
stores them. Stored rows carry ``is_deleted``, ``created_at`` and ``updated_at``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.columns import content_id
from lodestone.operators.window import dedupe_on, top_k

STAMPS = ["is_deleted", "created_at", "updated_at"]


def hash_id(df: DataFrame, columns: Sequence[str], name: str = "id") -> DataFrame:
    """64-bit content id. (A 32-bit hash collides from some ten thousand rows on.)"""
    return df.withColumn(name, content_id(*columns))


def stamped(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the audit columns of a fresh row."""
    now = F.current_timestamp() if now is None else now
    return df.withColumns({"is_deleted": F.lit(0), "created_at": now, "updated_at": now})


def active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_deleted") == 0)


def unseen_rows(target: DataFrame, source: DataFrame, key: str,
                order: Sequence[Column] | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``, one per key.

    The survivor among equal keys is the first in ``order`` (by default any, picked inside the
    tasks before the shuffle).
    """
    rows = source.filter(F.col(key).isNotNull())
    rows = rows.dropDuplicates([key]) if order is None else dedupe_on(rows, [key], order)
    return rows.join(target.select(key), key, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, key: str,
                     order: Sequence[Column] | None = None) -> DataFrame:
    """``target`` plus the unseen rows of ``source``; columns missing there are null. Only the
    active rows of ``target`` count as seen."""
    seen = active(target) if "is_deleted" in target.columns else target
    fresh = unseen_rows(seen, source, key, order)
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def upsert(target: DataFrame, changes: DataFrame, key: str, now: Column | None = None,
           insert: bool = True, order: Sequence[Column] | None = None) -> DataFrame:
    """Apply partial rows by key: a null in ``changes`` leaves the old value.

    Soft-deleted rows stay untouched. Unknown keys are inserted unless ``insert`` is off.
    Of several changes of a key the first in ``order`` holds; without an order they are an error.
    Changes without a key change nothing; columns that the target lacks only serve the order.
    """
    columns = [c for c in changes.columns if c != key and c in target.columns]
    changes = changes.filter(F.col(key).isNotNull())
    if order is None:
        row = F.first(F.struct(*columns) if columns else F.lit(0))
        once = changes.groupBy(key).agg(F.when(F.count(F.lit(1)) == 1, row).otherwise(
            F.raise_error(F.lit(f"several changes of one {key}"))).alias("_row"))
        changes = once.select(key, *[F.col("_row")[c].alias(c) for c in columns])
    else:
        changes = dedupe_on(changes, [key], order)
    named = changes.select(F.col(key).alias("_key"),
                           *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(named, F.col(key) == F.col("_key"), "full" if insert else "left")
    known = F.col(key).isNotNull()
    flagged = "is_deleted" in target.columns
    live = F.col("is_deleted") == 0 if flagged else F.lit(True)
    hit = F.col("_key").isNotNull() & F.when(known, live).otherwise(F.lit(True))
    out = {c: F.when(hit, F.coalesce(F.col(f"_new_{c}").cast(target.schema[c].dataType),
                                     F.col(c))).otherwise(F.col(c)) for c in columns}
    out[key] = F.coalesce(key, "_key")
    if flagged:
        out["is_deleted"] = F.coalesce("is_deleted", F.lit(0))
    if now is not None and "updated_at" in target.columns:
        out["updated_at"] = F.when(hit, now).otherwise(F.col("updated_at"))
        out["created_at"] = F.when(known, F.col("created_at")).otherwise(now)
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in target.columns])


def _flagged(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``target`` with ``_hit``: whether the row's key is among ``keys``."""
    wanted = keys.select(F.col(key).alias("_key")).distinct()
    return (target.join(wanted, F.col(key) == F.col("_key"), "left")
            .withColumn("_hit", F.col("_key").isNotNull()).drop("_key"))


def set_field(target: DataFrame, keys: DataFrame, key: str, column: str, value: object,
              now: Column | None = None) -> DataFrame:
    """Set one field, cast to the column's type, for many keys; active rows only."""
    hit = F.col("_hit") & (F.col("is_deleted") == 0)
    new = F.lit(value).cast(target.schema[column].dataType)
    out = _flagged(target, keys, key).withColumn(
        column, F.when(hit, new).otherwise(F.col(column)))
    if now is not None and "updated_at" in target.columns:
        out = out.withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at")))
    return out.drop("_hit")


def matching_active(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Active rows whose key is among ``keys``: what a change or deletion will touch."""
    return active(target).join(keys.select(key), key, "left_semi").select(*target.columns)


def soft_delete(target: DataFrame, keys: DataFrame, key: str, reason: str,
                now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(table with the rows flagged, audit rows to append). Rows already deleted are neither
    flagged nor audited again."""
    now = F.current_timestamp() if now is None else now
    audit = (matching_active(target, keys, key).drop(*STAMPS)
             .withColumn("deleted_at", now).withColumn("deleted_reason", F.lit(reason)))
    return set_field(target, keys, key, "is_deleted", 1, now), audit


def undelete(target: DataFrame, keys: DataFrame, key: str, now: Column | None = None) -> DataFrame:
    """Undo a soft delete; the audit rows stay."""
    hit = F.col("_hit") & (F.col("is_deleted") == 1)
    out = _flagged(target, keys, key)
    if now is not None and "updated_at" in target.columns:
        out = out.withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at")))
    out = out.withColumn("is_deleted", F.when(hit, F.lit(0)).otherwise(F.col("is_deleted")))
    return out.drop("_hit")


def hard_delete(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Remove the rows for good."""
    return target.join(keys.select(key), key, "left_anti").select(*target.columns)


def recent_deleted(audit: DataFrame, key: str, n: int = 100) -> DataFrame:
    """Latest deletions first."""
    return top_k(audit, [F.desc("deleted_at"), F.asc(key)], n)


def restore_merge(current: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """``current`` plus snapshot rows with unknown ids; a soft-deleted id counts as known."""
    return union_like(current, unseen_rows(current, snapshot, key))


def union_like(current: DataFrame, rows: DataFrame) -> DataFrame:
    """Append ``rows`` in the column order of ``current``."""
    return current.unionByName(rows, allowMissingColumns=True).select(*current.columns)
