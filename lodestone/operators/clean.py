"""Filters, casts, null handling, search and paging."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.quantiles import exact_quantiles


def keep_valid(df: DataFrame, not_null: Iterable[str] = (), not_empty: Iterable[str] = (),
               positive: Iterable[str] = (), non_negative: Iterable[str] = ()) -> DataFrame:
    """Rows whose named columns are present / not '' / above zero / not below zero."""
    for c in not_null:
        df = df.filter(F.col(c).isNotNull())
    for c in not_empty:
        df = df.filter(F.col(c) != "")
    for c in positive:
        df = df.filter(F.col(c) > 0)
    for c in non_negative:
        df = df.filter(F.col(c) >= 0)
    return df


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that does not parse becomes null rather than an error."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a constant per column."""
    return df.fillna(dict(values))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the exact column median (mean of the two middle values when even)."""
    out = df
    for c in columns:
        median = exact_quantiles(df, [], c, [0.5], interpolate=True).select("quantile").scalar()
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), median))
    return out


def search_text(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Case-sensitive substring search over several columns."""
    needle = text.strip()
    return df.filter(_any_of(F.col(c).contains(needle) for c in columns))


@dataclass
class Facets:
    """Filter settings for :func:`faceted_filter`; an empty setting filters nothing."""

    contains_any: Mapping[str, Sequence[str]] = field(default_factory=dict)
    one_of: Mapping[str, Sequence] = field(default_factory=dict)
    equals: Mapping[str, object] = field(default_factory=dict)
    range_or_null: Mapping[str, tuple] = field(default_factory=dict)
    range_strict: Mapping[str, tuple] = field(default_factory=dict)
    all_tokens: Mapping[str, Sequence[str]] = field(default_factory=dict)


def faceted_filter(df: DataFrame, facets: Facets) -> DataFrame:
    """Conjunction of facet filters.

    ``range_or_null`` keeps rows whose value is unknown, ``range_strict`` drops them. Every
    listed place filters, however many there are (with two or more, a multi-place row matches
    when it contains any of them). A range bound of None is open; an upper bound of 0 or less
    counts as open.
    """
    for c, values in facets.contains_any.items():
        if values:
            df = df.filter(_any_of(F.col(c).contains(v) for v in values))
    for c, values in facets.one_of.items():
        if values:
            df = df.filter(F.col(c).isin(*values))
    for c, value in facets.equals.items():
        if value is not None:
            df = df.filter(F.col(c) == value)
    for c, (low, high) in facets.range_or_null.items():
        if low is not None:
            df = df.filter(F.col(c).isNull() | (F.col(c) >= low))
        if high is not None and high > 0:
            df = df.filter(F.col(c).isNull() | (F.col(c) <= high))
    for c, (low, high) in facets.range_strict.items():
        if low is not None:
            df = df.filter(F.col(c) >= low)
        if high is not None and high > 0:
            df = df.filter(F.col(c) <= high)
    for c, tokens in facets.all_tokens.items():
        for token in tokens:
            df = df.filter(F.lower(F.col(c)).contains(token.lower()))
    return df


def paginate(df: DataFrame, sort: str, tie: str, ascending: bool = True, page: int = 1,
             size: int = 20) -> DataFrame:
    """Page ``page`` (from 1) of the sorted rows, nulls last, with the total in ``total_rows``.

    Only the first page*size rows are ever sorted out (a top-k, not a full sort), and the total
    is one aggregate inside the same plan.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    order = F.col(sort).asc_nulls_last() if ascending else F.col(sort).desc_nulls_last()
    rows = df.orderBy(order, F.col(tie).asc()).limit(page * size).offset((page - 1) * size)
    return rows.withColumn("total_rows", total)


def active_row(df: DataFrame, key: str, value: object, flag: str = "is_deleted") -> DataFrame:
    """The row with this key, unless it is soft-deleted."""
    return df.filter((F.col(key) == F.lit(value)) & (F.col(flag) == 0))


def display_columns(df: DataFrame, names: Mapping[str, str],
                    flags: Iterable[str] = ()) -> DataFrame:
    """Choose and rename columns for display; ``flags`` become booleans."""
    as_bool = set(flags)
    return df.select([
        (F.col(c).cast("boolean") if c in as_bool else F.col(c)).alias(n)
        for c, n in names.items()
    ])


def value_label(c: str, placeholder: str, replacement: str, unit: str,
                local_marks: Sequence[str]) -> Column:
    """Display text of an amount: missing or placeholder text is replaced, and a stray ``unit``
    is dropped from amounts that carry a local currency mark."""
    text = F.col(c)
    missing = text.isNull() | (text == "") | (F.lower(text) == "nan") | text.contains(placeholder)
    local = _any_of(F.lower(text).contains(m) for m in local_marks)
    dropped = F.trim(F.regexp_replace(text, " ?\\Q" + unit + "\\E", ""))
    return F.when(missing, F.lit(replacement)).when(local, dropped).otherwise(text)


def _any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
