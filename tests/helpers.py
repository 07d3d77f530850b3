"""Comparison of results from two engines."""

from __future__ import annotations

import math


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


def table(columns, rows):
    """Column names sorted, rows in the same order and sorted by text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr))


def of_spark(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
