"""Statistics and anti joins. Broadcasts are left to adaptive execution, which decides on the
measured size of a side and falls back to a shuffled join with skew splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.quantiles import exact_quantiles


def join_group_stats(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Group statistics joined back to the rows."""
    return df.join(df.groupBy(*keys).agg(*aggs), list(keys))


def without_match(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    keys = other.select(F.col(other_key or key).alias("_key")).filter(F.col("_key").isNotNull())
    return df.join(keys, F.col(key) == F.col("_key"), "left_anti")


def upper_outliers(df: DataFrame, key: str, value: str, factor: float = 1.5) -> DataFrame:
    """Rows above Q3 + factor * IQR of their group (strictly above, high side only).

    The quartiles are exact; the rows come back with the fence of their group.
    """
    quartiles = exact_quantiles(df, [key], value, [0.25, 0.75])
    fences = quartiles.groupBy(key).agg(
        F.min(F.when(F.col("p") == 0.25, F.col("quantile"))).alias("q1"),
        F.min(F.when(F.col("p") == 0.75, F.col("quantile"))).alias("q3"),
    ).withColumn("fence", F.col("q3") + (F.col("q3") - F.col("q1")) * factor)
    return df.join(fences, key).filter(F.col(value) > F.col("fence"))
