"""Exact group quantiles that never gather a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
# Groups up to this size are ranked whole; larger ones only inside the sketch's error band.
SMALL_GROUP = 10_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float],
                    interpolate: bool = False) -> DataFrame:
    """Exact quantiles per group: columns ``keys``, ``p``, ``n``, ``quantile``.

    Pass 1 sketches every group and so brackets each wanted rank between two values that hold
    between them a few ten-thousandths of the group. Pass 2 counts the rows below the bracket
    (partial aggregation) and ranks only the distinct values inside it. A group that holds a
    third of all rows is therefore never sorted in one task. The sketch's error is bounded well
    inside the bracket; a bracket that missed its rank all the same would raise an error.

    The plain form returns the element at rank ceil(p*n); ``interpolate`` returns the linear
    interpolation at (n-1)*p.
    """
    margin = 4.0 / ACCURACY
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))

    def bound(p: float, low: bool) -> Column:
        q = p - margin if low else p + margin
        edge = F.min("_v") if low else F.max("_v")
        if not 0.0 < q < 1.0:
            return edge
        return F.when(F.count("_v") <= SMALL_GROUP, edge).otherwise(
            F.percentile_approx("_v", q, ACCURACY))

    brackets = F.array(*[
        F.struct(F.lit(float(p)).alias("p"), bound(p, True).alias("lo"),
                 bound(p, False).alias("hi"))
        for p in ps
    ])
    stats = rows.groupBy(*keys).agg(F.count("_v").alias("n"), brackets.alias("_b"))

    if keys:
        # Null-safe, so that the null group is a group like any other.
        named = stats.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "n", "_b")
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        joined = rows.join(named, same).drop(*[f"_k{i}" for i in range(len(keys))])
    else:
        one = stats.select(F.struct("n", "_b").alias("s")).scalar()
        joined = rows.withColumn("_s", one).select("_v", "_s.n", "_s._b")

    marked = (joined.select(*keys, "n", "_v", F.explode("_b").alias("_q"))
              .filter(F.col("_v") <= F.col("_q.hi"))
              .select(*keys, "n", F.col("_q.p").alias("p"),
                      F.when(F.col("_v") >= F.col("_q.lo"), F.col("_v")).alias("_v")))
    counts = marked.groupBy(*keys, "p", "n", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = (Window.partitionBy(*keys, "p").orderBy(F.col("_v").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("_r", F.sum("_c").over(upto))
    below = F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_r"))), F.lit(0))
    ranked_values = F.col("_v").isNotNull()

    group = [*keys, "p", "n"]
    if not interpolate:
        wanted = F.greatest(F.ceil(F.col("p") * F.col("n")), F.lit(1))
        found = F.min(F.when(ranked_values & (F.col("_r") >= wanted), F.col("_v")))
        spots = ranked.groupBy(*group).agg(found.alias("_q"), below.alias("_below"))
        right = F.col("_q").isNotNull() & (F.col("_below") < wanted)
        return spots.select(*group, F.when(right, F.col("_q")).otherwise(
            F.raise_error(F.lit("a quantile bracket missed its rank"))).alias("quantile"))
    spot = (F.col("n") - 1) * F.col("p")
    low = F.floor(spot) + 1
    high = F.ceil(spot) + 1
    pair = ranked.groupBy(*group).agg(
        F.min(F.when(ranked_values & (F.col("_r") >= low), F.col("_v"))).alias("_lo"),
        F.min(F.when(ranked_values & (F.col("_r") >= high), F.col("_v"))).alias("_hi"),
        below.alias("_below"))
    missed = F.col("_hi").isNull() | (F.col("_below") >= low)
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (spot - F.floor(spot))
    return pair.select(*group, F.when(missed, F.raise_error(F.lit(
        "a quantile bracket missed its rank")).cast("double")).otherwise(
            between.cast("double")).alias("quantile"))
