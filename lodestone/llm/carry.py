"""Carrying a table's further columns through an operator, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CORE = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = "_carried_columns"


def packed(docs: DataFrame) -> DataFrame:
    """The columns of a document table, and all others as one struct, so that no name clashes."""
    core = [c for c in docs.columns if c in CORE]
    rest = [c for c in docs.columns if c not in CORE]
    return docs.select(*core, *([F.struct(*[F.col(f"`{c}`") for c in rest]).alias(CARRIED)]
                                if rest else []))


def unpacked(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """The original ``columns`` again, and ``more``."""
    return df.select(*[F.col(c) if c in CORE else F.col(CARRIED)[c].alias(c) for c in columns],
                     *more)
