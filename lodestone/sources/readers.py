"""Scans. Every reader takes an explicit schema; inference is an extra scan and only on request."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lodestone.operators.clean import typed
from lodestone.sources.csv_records import read_csv_split

Schema = StructType | str | None


def read_csv(spark: SparkSession, path: str, schema: Schema = None, infer: bool = False,
             **options: str) -> DataFrame:
    """CSV with a header line."""
    reader = spark.read.options(header=True, **options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.csv(path, inferSchema=infer)


def read_csv_typed(spark: SparkSession, path: str, types: Mapping[str, str],
                   line_breaks: bool = True) -> DataFrame:
    """Quoted UTF-8 CSV: read as text, then cast by column; bad text becomes null.

    With ``line_breaks`` a field may hold line breaks; large files are split all the same, for
    which they are read twice (see :mod:`lodestone.sources.csv_records`). Turn it off where no
    field does.
    """
    raw = read_csv_split(spark, path) if line_breaks else spark.read.csv(
        path, header=True, escape='"', encoding="utf-8", inferSchema=False)
    return typed(raw, types).select(*types)


def read_json(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    """JSON lines."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table."""
    return spark.table(name)


def read_source(spark: SparkSession, fmt: str, schema: Schema = None, **options: str) -> DataFrame:
    """Any installed connector; its options, credentials included, come from the caller."""
    reader = spark.read.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load()


def read_by_kind(spark: SparkSession, kind: str, location: str, schema: Schema = None,
                 **options: str) -> DataFrame:
    """Source chosen by a parameter: ``csv``, ``json``, ``parquet``, ``table``, or a connector
    format, for which ``location`` is its path option."""
    if kind == "csv":
        return read_csv(spark, location, schema, **options)
    if kind == "json":
        return read_json(spark, location, schema)
    if kind == "parquet":
        return read_parquet(spark, location)
    if kind == "table":
        return read_table(spark, location)
    return read_source(spark, kind, schema, path=location, **options)
