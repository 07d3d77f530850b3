"""CSV with line breaks inside quotes, read in splits.

Whether a split begins inside a quoted field depends on the number of quotes before it. Pass 1
counts the quotes of each split; their prefix sums give the state at each border. Pass 2 walks
over the lines of every split in its known state: lines are joined to records, and what crosses a
border (the end of one split, the beginning of the next, whole splits between them) is put
together in one small exchange. So a file is read by as many tasks as it has splits.

Quotes have to be balanced, as writers that quote fields and double the quotes in them leave them
(RFC 4180). A file that ends inside a quoted field gives what there is as its last record.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, BEGIN, MIDDLE, END = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, _file, _at``: the lines of every split, in their order within each task."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_at"))


def open_splits(lines: DataFrame) -> DataFrame:
    """``_file, _at, _open``: whether the split begins inside a quoted field."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    counts = lines.groupBy("_file", "_at").agg(F.sum(quotes).alias("_n"))
    before = (Window.partitionBy("_file").orderBy("_at")
              .rowsBetween(Window.unboundedPreceding, -1))
    odd = F.coalesce(F.sum("_n").over(before), F.lit(0)) % 2 == 1
    return counts.select("_file", "_at", odd.alias("_open"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records, split by split: ``_file, _at, _kind, _text``."""
    where: tuple | None = None
    held: list[str] = []
    begun = inside = False    # a record began in this split; the next line continues a field
    out: list[tuple] = []

    def ended() -> None:
        """The split is over: an open record goes on in the next one."""
        if where is not None and inside:
            out.append((*where, BEGIN if begun else MIDDLE, "\n".join(held)))

    for batch in batches:
        quotes = pc.count_substring(batch["value"], '"').to_numpy(zero_copy_only=False) % 2
        files, places = batch["_file"].to_pylist(), batch["_at"].to_pylist()
        opened = batch["_open"].to_pylist()
        for line, odd, file, at, starts_open in zip(batch["value"].to_pylist(), quotes, files,
                                                    places, opened):
            if where != (file, at):
                ended()
                where, held, begun, inside = (file, at), [], not starts_open, starts_open
            if not inside and not odd:
                if line.rstrip("\r"):
                    out.append((*where, WHOLE, line))
                continue
            held.append(line)
            if odd:
                inside = not inside
                if not inside:
                    out.append((*where, WHOLE if begun else END, "\n".join(held)))
                    held = []
                begun = True
            if len(out) >= 4096:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)
            out = []
    ended()
    if out:
        yield _batch(out)


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["_file", "_at", "_kind", "_text"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``_text``: the records of all files as text, without their header lines and empty lines."""
    lines = _lines(spark, path)
    # One row for each split of the scan, which the driver lists anyway.
    states = F.broadcast(open_splits(lines))
    pieces = lines.join(states, ["_file", "_at"]).select("value", "_file", "_at", "_open").mapInArrow(
        _marked, "_file string, _at long, _kind int, _text string, _first boolean")
    whole = pieces.filter((F.col("_kind") == WHOLE) & ~F.col("_first")).select("_text")
    order = Window.partitionBy("_file").orderBy("_at", F.col("_kind") == BEGIN)
    crossing = pieces.filter(F.col("_kind") != WHOLE).withColumn(
        "_record", F.sum((F.col("_kind") == BEGIN).cast("int")).over(order))
    joined = crossing.groupBy("_file", "_record").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_text"))).alias("_parts"),
        F.max("_first").alias("_first"))
    texts = F.transform("_parts", lambda p: p["_text"])
    return whole.unionByName(joined.filter(~F.col("_first")).select(
        F.array_join(texts, "\n").alias("_text")))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces, and whether each is the first record of its file (the header)."""
    seen = None
    for part in _pieces(batches):
        first = np.zeros(len(part), bool)
        files, places = part["_file"].to_pylist(), part["_at"].to_pylist()
        for i, (file, at) in enumerate(zip(files, places)):
            if at == 0 and file != seen:
                first[i], seen = True, file
        yield part.append_column("_first", pa.array(first))


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files below ``path`` as text columns, named by the header of the first file."""
    head = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="utf-8",
                          inferSchema=False).schema
    schema = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in head.fields)
    # Where records end in "\r\n", the multi-line reader reads these as "\n" within fields, too.
    text = F.when(F.endswith("_text", F.lit("\r")), F.replace(
        F.substring("_text", F.lit(1), F.length("_text") - 1), F.lit("\r\n"), F.lit("\n"))).otherwise(
            F.col("_text"))
    parsed = F.from_csv(text, F.lit(schema), {"escape": '"'})
    return csv_records(spark, path).select(parsed.alias("_r")).select("_r.*")
