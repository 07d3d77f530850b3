"""Fixed-width text reports, laid out by column expressions and written by Spark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """One report column. ``fmt`` is a printf pattern such as "%.1f" or "%d"."""

    column: str
    width: int
    right: bool = False
    fmt: str | None = None
    missing: str = ""

    def text(self) -> Column:
        c = F.col(self.column)
        shown = c.cast("string") if self.fmt is None else F.format_string(self.fmt, c)
        shown = F.coalesce(F.when(c.isNotNull(), shown), F.lit(self.missing))
        pad = F.lpad if self.right else F.rpad
        return pad(shown, self.width, " ")


def bar(percent: str, per_block: float = 2.0, block: str = "█") -> Column:
    """A bar of one block per ``per_block`` percent."""
    return F.repeat(F.lit(block), F.floor(F.col(percent) / per_block).cast("int"))


def text_report(df: DataFrame, fields: Sequence[Field], sep: str = " | ",
                tail: Column | None = None, name: str = "line") -> DataFrame:
    """One string column, a line per row, columns cut and padded to their widths."""
    parts = [f.text() for f in fields] + ([] if tail is None else [tail])
    return df.select(F.concat_ws(sep, *parts).alias(name))


def write_report(report: DataFrame, path: str) -> None:
    """Write the lines in their order as one text file (reports hold few rows)."""
    report.coalesce(1).write.mode("overwrite").text(path)
