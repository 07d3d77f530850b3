"""Scalar column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: ColumnLike, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(as_col(value)), body), F.lit(0))


def scaled(c: ColumnLike, unit: float = 1e6, digits: int = 1) -> Column:
    """Value in ``unit``s, rounded (money in millions by default)."""
    return F.round(as_col(c) / F.lit(float(unit)), digits)


def positive(c: ColumnLike) -> Column:
    """The value where it is above zero, else null, so aggregates skip it."""
    return F.when(as_col(c) > 0, as_col(c))


def percent(part: ColumnLike, total: ColumnLike, digits: int = 2) -> Column:
    """Share in percent; null when the total is zero."""
    return F.round(F.try_divide(as_col(part) * F.lit(100.0), as_col(total)), digits)


def percent_difference(value: ColumnLike, base: ColumnLike, digits: int = 2) -> Column:
    """How far ``value`` lies above (+) or below (-) ``base``, in percent of ``base``."""
    gap = (as_col(value) - as_col(base)) * F.lit(100.0)
    return F.round(F.try_divide(gap, as_col(base)), digits)


def first_match(c: ColumnLike, rules: Sequence[tuple[Sequence[str], str]], default: str | None,
                how: str = "contains", lower: bool = False) -> Column:
    """Label of the first rule that matches: ``rules`` is an ordered list of (patterns, label).

    ``how`` is ``contains``, ``like`` or ``rlike``. Substring semantics on purpose: the
    pattern "ai" also hits "email".
    """
    def choose(text: Column) -> Column:
        out = None
        for patterns, label in rules:
            hit = None
            for p in patterns:
                test = getattr(text, how)(p)
                hit = test if hit is None else hit | test
            out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
        return out.otherwise(F.lit(default))

    text = F.coalesce(as_col(c), F.lit(""))
    return let(F.lower(text), choose) if lower else choose(text)


def whitelist(c: ColumnLike, allowed: Sequence, default: str) -> Column:
    """Allowed values pass; anything else, and null, becomes ``default``."""
    return F.when(as_col(c).isin(*allowed), as_col(c)).otherwise(F.lit(default))


def flag_label(c: ColumnLike, yes: str, no: str) -> Column:
    """1 → ``yes``; everything else, null included, → ``no``."""
    return F.when(as_col(c) == 1, F.lit(yes)).otherwise(F.lit(no))


def bucket_index(c: ColumnLike, edges: Sequence[float], right_closed: bool = False) -> Column:
    """1-based bucket number for ``len(edges)+1`` buckets; null stays null.

    Half-open ``[a, b)`` buckets by default, ``(a, b]`` with ``right_closed``.
    """
    v = as_col(c)
    out = F.when(v.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(edges, start=1):
        out = out.when(v <= edge if right_closed else v < edge, F.lit(i))
    return out.otherwise(F.lit(len(edges) + 1))


def bucket_label(index: ColumnLike, labels: Sequence[str]) -> Column:
    """Label of a 1-based bucket number."""
    return F.get(F.array(*[F.lit(x) for x in labels]), as_col(index) - 1)


def token_array(c: ColumnLike, sep: str = ",", lower: bool = True, distinct: bool = False,
                ordered: bool = False) -> Column:
    """Split a delimited string, trim, drop empties; null gives an empty array."""
    text = F.coalesce(as_col(c), F.lit(""))
    parts = F.split(F.lower(text) if lower and sep == sep.lower() == sep.upper() else text,
                    "\\Q" + sep + "\\E")
    if lower and not sep == sep.lower() == sep.upper():
        parts = F.transform(parts, lambda x: F.lower(x))
    out = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    if distinct:
        out = F.array_distinct(out)
    return F.array_sort(out) if ordered else out


def combine_text(*cols: ColumnLike, sep: str = " ") -> Column:
    """Join text columns; a null counts as empty but keeps its place."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def content_id(*cols: ColumnLike) -> Column:
    """64-bit id from the content of the columns (null counts as empty)."""
    return F.xxhash64(combine_text(*cols, sep="|"))


def cosine(a: ColumnLike, b: ColumnLike) -> Column:
    """Cosine of two numeric arrays, in double precision."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    x, y = as_col(a), as_col(b)
    return F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))
