"""Catalog databases and tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The advert table: 18 source columns between the id and three audit columns.
JOB_COLUMNS = """source STRING, title_clean STRING, company STRING, salary STRING,
    salary_clean STRING, salary_min_vnd DOUBLE, salary_max_vnd DOUBLE, salary_final_vnd DOUBLE,
    is_AI_predicted INT, impute_method STRING, location_clean STRING, is_remote INT,
    job_level STRING, yoe_extracted DOUBLE, skills_clean STRING, skill_count INT,
    description_clean STRING, url STRING"""
JOBS = f"id BIGINT, {JOB_COLUMNS}, is_deleted INT, created_at TIMESTAMP, updated_at TIMESTAMP"
JOBS_DELETED = f"id BIGINT, {JOB_COLUMNS}, deleted_at TIMESTAMP, deleted_reason STRING"
SNAPSHOT_META = """backup_id STRING, backup_name STRING, backup_path STRING, record_count BIGINT,
    table_version INT, description STRING, status STRING, created_at TIMESTAMP"""


def create_tables(spark: SparkSession, database: str, tables: Mapping[str, str],
                  location: str | None = None) -> None:
    """Create a database and Parquet tables (Snappy) from ``name: DDL`` pairs."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
                  "OPTIONS (compression 'snappy')")


def drop_database(spark: SparkSession, database: str, confirm: bool = False) -> None:
    """Drop a database with everything in it; refuses without ``confirm``."""
    if not confirm:
        raise ValueError(f"dropping {database} needs confirm=True")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table (footer statistics only: no column is read)."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionAll(row)
    return out
