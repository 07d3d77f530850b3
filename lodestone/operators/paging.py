"""Deep pages of sorted rows without sorting the rows before them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, FloatType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

ACCURACY = 10_000
#: Rows among which a page is simply sorted out.
FEW = 50_000
_CHUNK = 6  # bytes, which a double holds exactly, as the sketch does
_CHUNKS = 4


def _keys(df: DataFrame, column: str, ascending: bool) -> tuple[list[tuple[Column, bool, int]], bool]:
    """Numbers that order the column, each with its direction and the number of keys to skip where
    it is null; and whether equal numbers mean equal values."""
    kind = df.schema[column].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        # A sum is not pushed into scans, whose statistics leave NaN out.
        return [(F.col(column) + F.lit(0.0), ascending, 1)], True
    if isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return [(F.col(column), ascending, 1)], True
    if isinstance(kind, StringType):
        raw = F.hex(F.encode(F.col(column), "UTF-8"))
        chunks = [F.conv(F.rpad(F.substring(raw, 2 * _CHUNK * i + 1, 2 * _CHUNK), 2 * _CHUNK, "0"), 16, 10)
                  .cast("long") for i in range(_CHUNKS)]
        return [(c, ascending, _CHUNKS - i) for i, c in enumerate(chunks)], False
    return [], False


def _page(rows: DataFrame, keys: list[tuple[Column, bool, int]], order: list[Column], offset: int,
          size: int, count: int) -> list[DataFrame]:
    """The rows at ``offset`` to ``offset + size`` as frames of at most ``size`` rows in all."""
    if not keys or count <= FEW:
        return [rows.orderBy(*order).limit(offset + size).offset(offset)]
    key, ascending, skip = keys[0]
    known = rows.agg(F.count(key)).first()[0]
    margin = 2.0 / ACCURACY
    first = offset if ascending else known - offset - size
    ends = [min(1.0, max(0.0, first / max(known, 1) - margin)),
            min(1.0, max(0.0, (first + size) / max(known, 1) + margin))]
    low, high = rows.agg(F.percentile_approx(key, ends, ACCURACY)).first()[0] or (None, None)
    parts: list[tuple[Column, list]] = []
    if low is not None:
        lo, hi = F.lit(low), F.lit(high)
        parts = [(key < lo, keys), (key == lo, keys[1:])]
        if low != high and not (low != low and high != high):  # not even both NaN
            parts += [((key > lo) & (key < hi), keys), (key == hi, keys[1:])]
        parts.append((key > hi, keys))
        parts = parts if ascending else parts[::-1]
    parts.append((key.isNull(), keys[skip:]))
    sizes = rows.agg(*[F.count_if(test).alias(f"n{i}") for i, (test, _) in enumerate(parts)]).first()
    found = []
    for (test, rest), n in zip(parts, sizes):
        if offset < n and size > 0:
            here = min(size, n - offset)
            # A part that is no smaller could not be bracketed: it is sorted out as it is.
            found += _page(rows.filter(test), rest if n < count or rest is not keys else [], order,
                           offset, here, n)
            offset, size = 0, size - here
        else:
            offset -= n
    return found


def deep_page(df: DataFrame, sort: str, tie: str, ascending: bool = True, page: int = 1,
              size: int = 20) -> DataFrame:
    """:func:`lodestone.operators.clean.paginate` for pages far from the beginning.

    A sketch brackets the page's values, exact counts say how many rows lie before, on and between
    the bracket's ends, and the search goes on in the parts that hold the page until few rows are
    left to sort. The rows before the page are counted, never sorted or moved. A value that many rows
    share becomes a part of its own, in which ``tie`` is searched. Strings are bracketed by their
    first 24 bytes. The rows are read a few times: store an expensive ``df`` first.
    """
    total = df.count()
    order = [F.col(sort).asc_nulls_last() if ascending else F.col(sort).desc_nulls_last(),
             F.col(tie).asc()]
    keys, exact = _keys(df, sort, ascending)
    if exact:
        keys += _keys(df, tie, True)[0]
    offset = (page - 1) * size
    found = _page(df, keys, order, offset, size, total) if offset < total else []
    rows = reduce(DataFrame.unionByName, found) if found else df.limit(0)
    return rows.orderBy(*order).withColumn("total_rows", F.lit(total).cast("long"))
