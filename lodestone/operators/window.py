"""Ranks, top-n per group, top-k, retention numbering, unions and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import cut_lineage


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark limits every group inside each input partition before the shuffle
    (``WindowGroupLimit``), so a hot group sends ``n`` rows per task, not all its rows. End
    ``order`` with a unique column to make the choice repeatable.
    """
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn("_rn", spot).filter(F.col("_rn") <= n)
    return out.drop("_rn") if rank is None else out.withColumnRenamed("_rn", rank)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows overall: one bounded heap per task, then one merge."""
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, measure: str, tie: str, k: int, rank: str = "rank") -> DataFrame:
    """Top ``k`` with a rank that leaves gaps after ties; ranked after the cut, so the
    unpartitioned window sees ``k`` rows at most."""
    best = top_k(df, [F.desc(measure), F.asc(tie)], k)
    return best.withColumn(rank, F.rank().over(Window.orderBy(F.desc(measure))))


def ranked_all(df: DataFrame, measure: str, rank: str = "rank") -> DataFrame:
    """Every row with its rank by ``measure``, highest first, with gaps after ties; nulls last.

    The distinct values are counted and range-partitioned; a rank is what lies in the partitions
    before, and before in its own. No task sees more than its range.
    """
    order = F.col(measure).desc_nulls_last()
    counts = df.groupBy(measure).agg(F.count(F.lit(1)).alias("_c"))
    parts = cut_lineage(counts.repartitionByRange(order)
                        .withColumn("_p", F.spark_partition_id()))
    totals = parts.groupBy("_p").agg(F.sum("_c").alias("_t"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_p", F.coalesce(F.sum("_t").over(before.orderBy("_p")), F.lit(0))
                           .alias("_start"))
    inside = (Window.partitionBy("_p").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (parts.withColumn("_in", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
             .join(starts, "_p")
             .select(F.col(measure).alias("_m"),
                     (F.col("_start") + F.col("_in") + 1).cast("int").alias(rank)))
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_m"))).drop("_m")


def sorted_nulls_last(df: DataFrame, column: str, tie: str, ascending: bool = True) -> DataFrame:
    """Sort with nulls last in either direction."""
    order = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    return df.orderBy(order, F.asc(tie))


def flag_newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], row_id: str, n: int,
                name: str = "kept") -> DataFrame:
    """Mark the ``n`` newest rows of each group. Only those are ever ranked (see
    :func:`top_n_per_group`); the other rows, however many, are just joined with them."""
    newest = top_n_per_group(df, keys, order, n).select(F.col(row_id).alias("_kept"))
    marked = df.join(newest, F.col(row_id) == F.col("_kept"), "left")
    return marked.withColumn(name, F.col("_kept").isNotNull()).drop("_kept")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing from a frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def dedupe_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return top_n_per_group(df, keys, order, 1)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows."""
    return df.distinct()
