"""Frequency tables, group profiles, pivots, cubes and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.columns import (bucket_index, bucket_label, percent, percent_difference,
                                         positive)
from lodestone.operators.quantiles import exact_quantiles
from lodestone.operators.window import top_n_per_group
from lodestone.session import cut_lineage


def value_counts(df: DataFrame, column: str, limit: int | None = None,
                 name: str = "n") -> DataFrame:
    """Frequency table, most frequent first; null is a group, ties go by value."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    out = out.orderBy(F.desc(name), F.asc_nulls_last(column))
    return out if limit is None else out.limit(limit)


def with_total(df: DataFrame, total: DataFrame, name: str) -> DataFrame:
    """Attach the single value of the one-row frame ``total`` to every row.

    A scalar subquery: no cross join, no second job, and the value reaches every task as a
    literal.
    """
    return df.withColumn(name, total.scalar())


def with_share(df: DataFrame, count: str, total: DataFrame | None = None,
               name: str = "share_pct", digits: int = 2) -> DataFrame:
    """Share of each row in the grand total (by default the sum of ``count`` over ``df``)."""
    whole = (df.agg(F.sum(count)) if total is None else total).scalar()
    return df.withColumn(name, percent(F.col(count), whole, digits))


def group_profile(df: DataFrame, keys: Sequence[str], value: str, unit: float = 1.0,
                  digits: int = 2, median: bool = False, extra: Mapping[str, Column] | None = None,
                  min_rows: int | None = None) -> DataFrame:
    """Per group: row count, and min / avg / max of the positive values in ``unit``s.

    ``median`` adds the exact median (the lower one of an even count), ``extra`` more aggregates,
    ``min_rows`` a minimum group size.
    """
    v = positive(value)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.round(F.min(v) / unit, digits).alias("min_value"),
        F.round(F.avg(v) / unit, digits).alias("avg_value"),
        F.round(F.max(v) / unit, digits).alias("max_value"),
    ]
    aggs += [c.alias(n) for n, c in (extra or {}).items()]
    out = df.groupBy(*keys).agg(*aggs)
    if min_rows is not None:
        out = out.filter(F.col("n") >= min_rows)
    if median:
        found = exact_quantiles(df.select(*keys, v.alias("_m")), keys, "_m", [0.5])
        named = found.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                             F.round(F.col("quantile") / unit, digits).alias("median_value"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        out = out.join(named, same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    return out


def joined_set(c: str, sep: str = " | ") -> Column:
    """Aggregate: the distinct values of a low-cardinality column, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def group_vs_market(df: DataFrame, group: str, value: str, experience: str, flag: str,
                    tokens: DataFrame, token: str, level: str, digits: int = 2) -> DataFrame:
    """Each group against the whole: count, share, average and its distance from the market
    average, maximum, mean experience, share of flagged rows, commonest token, levels seen.

    ``tokens`` holds (group, token) rows. The commonest token is counted before it is ranked,
    so no group's tokens are gathered in one place.
    """
    v = positive(value)
    market = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg(v).alias("avg")).alias("m"))
    profile = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("_avg"),
        F.round(F.max(v), digits).alias("max_value"),
        F.round(F.avg(experience), digits).alias("avg_experience"),
        F.round(F.avg(F.col(flag).cast("double")) * 100, digits).alias("flag_pct"),
        joined_set(level).alias("levels"),
    )
    common = top_n_per_group(
        tokens.groupBy(group, token).agg(F.count(F.lit(1)).alias("_c")),
        [group], [F.desc("_c"), F.asc(token)], 1,
    ).select(group, F.col(token).alias("top_token"))
    out = with_total(profile.join(common, group, "left"), market, "_m")
    return out.select(
        group, "n",
        percent(F.col("n"), F.col("_m.n"), digits).alias("share_pct"),
        F.round("_avg", digits).alias("avg_value"),
        percent_difference(F.col("_avg"), F.col("_m.avg"), digits).alias("vs_market_pct"),
        "max_value", "avg_experience", "flag_pct", "top_token", "levels",
    )


def summary(df: DataFrame, key: str, distinct: Sequence[str], averages: Sequence[str],
            extremes: Sequence[str], digits: int = 4) -> DataFrame:
    """One row: count of ``key``, exact distinct counts, averages, minima and maxima."""
    return df.agg(
        F.count(key).alias("total"),
        *[F.countDistinct(c).alias(f"distinct_{c}") for c in distinct],
        *[F.round(F.avg(c), digits).alias(f"avg_{c}") for c in averages],
        *[F.min(c).alias(f"min_{c}") for c in extremes],
        *[F.max(c).alias(f"max_{c}") for c in extremes],
    )


def conditional_counts(df: DataFrame, key: str, flag: Column, value: str, yes: str, no: str,
                       unit: float = 1.0, digits: int = 2) -> DataFrame:
    """Per group: count and average of the flagged and of the other rows, side by side."""
    hit = F.coalesce(flag, F.lit(False))
    v = positive(value)
    return df.groupBy(key).agg(
        F.count_if(hit).alias(f"n_{yes}"),
        F.count_if(~hit).alias(f"n_{no}"),
        F.round(F.avg(F.when(hit, v)) / unit, digits).alias(f"avg_{yes}"),
        F.round(F.avg(F.when(~hit, v)) / unit, digits).alias(f"avg_{no}"),
    )


def pivot_average(df: DataFrame, key: str, pivot: str, values: Sequence[str], value: str,
                  anchor: str, top: int, unit: float = 1.0, digits: int = 1) -> DataFrame:
    """Average of ``value`` per key and named pivot value, missing cells 0.

    Keeps keys above zero in the ``anchor`` column and ranks them by the mean of all the
    columns, zeros included.
    """
    cells = (df.groupBy(key).pivot(pivot, list(values))
             .agg(F.round(F.avg(value) / unit, digits))
             .fillna(0.0, subset=list(values)))
    mean = sum((F.col(f"`{v}`") for v in values), F.lit(0.0)) / len(values)
    return (cells.withColumn("row_mean", F.round(mean, 4))
            .filter(F.col(f"`{anchor}`") > 0)
            .orderBy(F.desc("row_mean"), F.asc(key)).limit(top))


def discover_values(df: DataFrame, column: str, limit: int = 1000) -> list:
    """The distinct values of a pivot column, sorted; an error when there are too many."""
    rows = (df.select(column).filter(F.col(column).isNotNull()).distinct()
            .limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return sorted(r[0] for r in rows)


def pivot_counts(df: DataFrame, key: str, pivot: str, values: Sequence | None = None,
                 total: str = "total") -> DataFrame:
    """Row counts per key and pivot value with a row total; discovers the values if not given."""
    values = discover_values(df, pivot) if values is None else list(values)
    cells = df.groupBy(key).pivot(pivot, values).agg(F.count(F.lit(1))).fillna(0)
    names = [str(v) for v in values]
    return (cells.withColumn(total, sum((F.col(f"`{v}`") for v in names), F.lit(0)))
            .orderBy(F.desc(total), F.asc_nulls_last(key)))


def crosstab_share(df: DataFrame, key: str, pivot: str, values: Sequence,
                   digits: int = 4) -> DataFrame:
    """Cross tabulation with every row normalised to sum to one."""
    counts = pivot_counts(df, key, pivot, values, total="_total")
    return counts.select(key, *[
        F.round(F.col(f"`{v}`") / F.col("_total"), digits).alias(str(v)) for v in values])


def cube_totals(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column] | None = None,
                averages: Mapping[str, Column] | None = None, digits: int = 1,
                count: str = "n", label: str = "ALL") -> DataFrame:
    """Row count, sums and averages for every subset of the dimensions; rolled-up dimensions
    read ``label``.

    The rows are first summed per full combination of dimensions. The cube, which copies its
    input once per subset, then runs on those few sums and not on the rows. Totals are told
    apart by grouping bits, not by null: a real null in a dimension stays null.
    """
    sums, averages = sums or {}, averages or {}
    parts = {f"_s{i}": c for i, c in enumerate([*sums.values(), *averages.values()])}
    base = df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for n, c in parts.items()],
        *[F.count(c).alias(f"_c{n}") for n, c in parts.items()])
    names = list(parts)
    totals = [F.sum(n).cast("double").alias(out) for n, out in zip(names, sums)]
    means = [F.round(F.try_divide(F.sum(n), F.sum(f"_c{n}")), digits).alias(out)
             for n, out in zip(names[len(sums):], averages)]
    marks = [F.grouping(d).alias(f"_g{i}") for i, d in enumerate(dims)]
    out = base.cube(*dims).agg(F.sum("_n").alias(count), *totals, *means, *marks)
    named = {
        d: F.when(F.col(f"_g{i}") == 1, F.lit(label)).otherwise(F.col(d).cast("string"))
        for i, d in enumerate(dims)
    }
    return (out.withColumns(named).drop(*[f"_g{i}" for i in range(len(dims))])
            .orderBy(*[F.asc_nulls_last(d) for d in dims]))


def cube_distinct(df: DataFrame, dims: Sequence[str], value: str, count: str = "n",
                  name: str = "n_distinct", label: str = "ALL") -> DataFrame:
    """Row count and exact number of distinct non-null values for every subset of the dimensions.

    The distinct values are numbered once, in runs without gaps. Each full combination of
    dimensions then keeps its values as bitmaps of 32,768 numbers, and every subset is the union of
    bitmaps: the rows are read once, not once per subset, and no list of values is ever built.
    """
    ids = cut_lineage(df.select(F.col(value).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
                      .withColumn("_id", F.monotonically_increasing_id()))
    rows = df.select(*dims, F.col(value).alias("_v")).join(ids, "_v", "left")
    base = rows.groupBy(*dims, F.bitmap_bucket_number("_id").alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))
    subsets = [[d for i, d in enumerate(dims) if mask >> i & 1] for mask in range(1 << len(dims))]
    marks = [F.grouping(d).alias(f"_g{i}") for i, d in enumerate(dims)]
    merged = base.groupingSets([[*map(F.col, s), F.col("_part")] for s in subsets], *dims, "_part").agg(
        F.sum("_n").alias("_n"), F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_bits"), *marks)
    named = {d: F.when(F.col(f"_g{i}") == 1, F.lit(label)).otherwise(F.col(d).cast("string"))
             for i, d in enumerate(dims)}
    groups = [f"_g{i}" for i in range(len(dims))]
    return (merged.groupBy(*dims, *groups).agg(F.sum("_n").alias(count), F.sum("_bits").alias(name))
            .withColumns(named).drop(*groups))


def bracket_counts(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str],
                   right_closed: bool = False, digits: int = 1) -> DataFrame:
    """Histogram over named brackets with the share of each."""
    marked = df.select(bucket_index(value, edges, right_closed).alias("bracket_no"))
    counts = (marked.filter(F.col("bracket_no").isNotNull())
              .groupBy("bracket_no").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("bracket", bucket_label("bracket_no", labels)))
    return with_share(counts, "n", digits=digits).orderBy("bracket_no")


def equal_width_histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included; the last bin is
    closed on the right."""
    rows = df.select(F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    span = rows.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("s")).scalar()
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    step = F.floor(F.try_divide(F.col("_v") - F.col("_s.lo"), width)) + 1
    place = F.when(width > 0, F.least(step, F.lit(bins))).otherwise(F.lit(1))  # one value only
    counts = (rows.withColumn("_s", span)
              .select(place.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    frame = (df.sparkSession.range(1, bins + 1, numPartitions=1).withColumnRenamed("id", "bin")
             .withColumn("_s", span))
    return (frame.join(counts, "bin", "left")
            .select("bin", (F.col("_s.lo") + (F.col("bin") - 1) * width).alias("low"),
                    (F.col("_s.lo") + F.col("bin") * width).alias("high"),
                    F.coalesce("n", F.lit(0)).alias("n"))
            .orderBy("bin"))


def top_n_stats(df: DataFrame, group: str, score: str, tie: str, n: int,
                digits: int = 4) -> DataFrame:
    """Maximum and mean of the ``n`` best rows of each group."""
    best = top_n_per_group(df, [group], [F.desc(score), F.asc(tie)], n)
    return best.groupBy(group).agg(F.count(F.lit(1)).alias("n"),
                                   F.max(score).alias("max_score"),
                                   F.round(F.avg(score), digits).alias("mean_score"))


def term_matrix(df: DataFrame, group: str, term: str, score: str, groups: Sequence[str],
                per_group: int = 8) -> DataFrame:
    """Scores of the best ``per_group`` terms of any group, one column per group, missing 0."""
    best = top_n_per_group(df, [group], [F.desc(score), F.asc(term)], per_group)
    kept = df.join(best.select(term).distinct(), term, "left_semi")
    return (kept.groupBy(term).pivot(group, list(groups)).agg(F.max(score))
            .fillna(0.0, subset=list(groups)).orderBy(term))


def class_means(df: DataFrame, label: str, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Row count and column means per class or cluster."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(c), digits).alias(f"avg_{c}") for c in columns])


def bucket_delta(df: DataFrame, measure: str, value: str, edges: Sequence[float],
                 labels: Sequence[str], unit: float = 1.0, digits: int = 1,
                 right_closed: bool = True) -> DataFrame:
    """Profile per bucket of ``measure`` and the change of the rounded average from one bucket
    to the next. The window runs over one row per bucket only."""
    marked = df.withColumn("bucket_no", bucket_index(measure, edges, right_closed))
    profile = group_profile(marked, ["bucket_no"], value, unit, digits, median=True)
    step = F.lag("avg_value").over(Window.orderBy("bucket_no"))
    return (profile.withColumn("bucket", bucket_label("bucket_no", labels))
            .withColumn("delta", F.round(F.col("avg_value") - step, digits))
            .orderBy("bucket_no"))
