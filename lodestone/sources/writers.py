"""Sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from lodestone.operators.tables import active

EXPORT_FORMATS = ("csv", "json", "parquet")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet, compressed with Snappy."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path, compression="snappy")


def write_sink(df: DataFrame, fmt: str, mode: str = "overwrite", **options: str) -> None:
    """Any installed connector."""
    df.write.format(fmt).options(**options).mode(mode).save()


def write_outputs(source: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
                  root: str) -> None:
    """Several results of one input, each below ``root``; the input is computed once."""
    held = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, make in outputs.items():
            write_parquet(make(held), f"{root}/{name}")
    finally:
        held.unpersist()


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table by column name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace the contents of a catalog table. ``df`` must not read that table itself; use a
    versioned table for in-place changes."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("overwrite").insertInto(name, overwrite=True)


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the active rows, without the deletion flag, as csv, json or parquet."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}; use one of {EXPORT_FORMATS}")
    rows = active(df).drop("is_deleted") if "is_deleted" in df.columns else df
    writer = rows.write.mode("overwrite")
    if fmt == "csv":
        # Quotes doubled and line breaks kept inside quotes, as read_csv_typed expects them.
        writer = writer.options(header=True, escape='"')
    writer.format(fmt).save(path)
