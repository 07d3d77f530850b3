"""Token counts of whole texts, huge ones in overlapping chunks that are spliced again.

A text longer than ``CHUNK`` characters is encoded in chunks of that length plus an overlap, each
chunk in a row of its own, so that one document can occupy many tasks. Two neighbours are spliced
at a position in their overlap where both encodings start a token and where that is proven: the
two characters around it are adjacent in no piece of the vocabulary, so no merge can ever reach
across, and merges on the two sides do not influence each other. An overlap without such a
position is widened (doubled) until it has one or reaches the end of the text.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows and null ids are counted
row by row; strings that look like special tokens are ordinary text, as is the library's default;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16
OVERLAP = 256
LIMIT = 4096
MODEL = "piece_bpe_32k.model"
_AT_ONCE = 1 << 20  # characters encoded by one call


@lru_cache(maxsize=1)
def _model(name: str):
    """The encoder, and the pairs of characters that stand side by side in some piece."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    joined = set()
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            piece = sp.id_to_piece(i).replace("▁", " ")
            joined.update(zip(piece, piece[1:]))
    # The model turns U+2581 and a space into the same symbol.
    joined |= {tuple("▁" if c == " " else c for c in p) for p in joined if " " in p}
    joined |= {(a, "▁") for a, b in joined if b == " "}
    joined |= {("▁", b) for a, b in joined if a == " "}
    joined |= {(" ", "▁"), ("▁", " "), ("▁", "▁"), (" ", " ")}
    return sp, joined


def stable_positions(text: str, low: int, high: int, model: str = MODEL) -> list[int]:
    """Positions in [low, high) before which a token must end, whatever else the text holds."""
    joined = _model(model)[1]
    return [i for i in range(max(low, 1), min(high, len(text)))
            if (text[i - 1], text[i]) not in joined]


def chunks(text: str, chunk: int = CHUNK, overlap: int = OVERLAP,
           model: str = MODEL) -> list[tuple[int, int, int, int]]:
    """``begin, head, tail, end`` of overlapping chunks.

    Chunk k covers [begin, end); it shares [begin, head) with the one before (empty for the first)
    and [tail, end) with the one after (empty for the last).
    """
    cuts = []
    at = chunk
    while at < len(text):
        width = overlap
        # The first character of a chunk is excluded: the model prefixes a space there.
        while not stable_positions(text, at + 1, at + width, model) and at + width < len(text):
            width *= 2
        if not stable_positions(text, at + 1, at + width, model):
            break
        cuts.append((at, min(len(text), at + width)))
        at = max(at + chunk, at + width)
    begins = [(0, 0), *cuts]
    ends = [*cuts, (len(text), len(text))]
    return [(b, head, tail, end) for (b, head), (tail, end) in zip(begins, ends)]


def boundary_counts(text: str, begin: int, head: int, tail: int, end: int, offset: int = 0,
                    model: str = MODEL) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
    """Tokens of one chunk, and those before each stable token start in its two overlaps.

    ``text`` is the chunk with one character before it (``offset`` 1) unless it is the first.
    Positions are those of the document.
    """
    sp = _model(model)[0]
    own = text[offset:]
    data = np.frombuffer(own.encode("utf-8", "surrogatepass"), np.uint8)
    characters = np.flatnonzero((data & 0xC0) != 0x80)  # the byte at which each character begins
    starts = np.searchsorted(characters, np.array(
        [p.begin for p in sp.encode(own, return_type="proto").pieces], np.int64))
    known = set((starts + begin).tolist())

    def counted(low: int, high: int) -> list[tuple[int, int]]:
        places = [p + begin - offset for p in stable_positions(
            text, low - begin + offset, high - begin + offset, model)]
        return [(p, int(np.searchsorted(starts, p - begin))) for p in places if p in known]

    return len(starts), counted(begin + 1, head), counted(tail + 1, end)


def token_counts(docs: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT,
                 model: str = MODEL) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0))
                       .cast("long").alias("n_bytes"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _model(model)[0]
        for batch in batches:
            counts: list[int] = []
            held: list[str] = []
            size = 0
            for text in batch["text"]:
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size > _AT_ONCE:
                    counts += map(len, sp.encode(held, num_threads=1))
                    held, size = [], 0
            counts += map(len, sp.encode(held, num_threads=1))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    fits = F.coalesce(F.length("text"), F.lit(0)) <= chunk
    short = rows.filter(fits).mapInArrow(whole, f"doc_id {kind}, n_bytes long, n_tokens long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch["_row"].to_pylist(), batch["text"]):
                text = text.as_py()
                found = chunks(text, chunk, overlap, model)
                for k, (begin, head, tail, end) in enumerate(found):
                    lead = min(begin, 1)
                    yield pa.RecordBatch.from_pylist([{
                        "_row": row, "_chunk": k, "begin": begin, "head": head, "tail": tail,
                        "end": end, "lead": lead, "part": text[begin - lead:end]}], chunk_schema)

    places = "array<struct<pos:long,n:long>>"
    chunk_schema = pa.schema([(c, pa.int64()) for c in (
        "_row", "_chunk", "begin", "head", "tail", "end", "lead")] + [("part", pa.string())])
    pair = pa.list_(pa.struct([("pos", pa.int64()), ("n", pa.int64())]))
    count_schema = pa.schema([("_row", pa.int64()), ("_chunk", pa.int64()), ("_n", pa.int64()),
                              ("_head", pair), ("_tail", pair)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, head, tail = boundary_counts(row["part"], row["begin"], row["head"], row["tail"],
                                                row["end"], row["lead"], model)
                yield pa.RecordBatch.from_pylist([{
                    "_row": row["_row"], "_chunk": row["_chunk"], "_n": n,
                    "_head": [{"pos": p, "n": c} for p, c in head],
                    "_tail": [{"pos": p, "n": c} for p, c in tail]}], count_schema)

    long = rows.filter(~fits).withColumn("_row", F.monotonically_increasing_id())
    parts = long.select("_row", "text").mapInArrow(
        cut, "_row long, _chunk long, begin long, head long, tail long, end long, lead long, "
             "part string").repartition("_row", "_chunk")
    counted = parts.mapInArrow(
        encode, f"_row long, _chunk long, _n long, _head {places}, _tail {places}")
    order = Window.partitionBy("_row").orderBy("_chunk")
    common = F.array_min(F.array_intersect("_tail.pos", F.lead("_head.pos").over(order)))
    spliced = (counted.withColumn("_end", common)
               .withColumn("_last", F.lead("_chunk").over(order).isNull())
               .withColumn("_start", F.lag("_end").over(order)))

    def at(column: str, position: str):
        return F.get(F.filter(column, lambda p: p["pos"] == F.col(position)), F.lit(0))["n"]

    upto = F.when(F.col("_last"), F.col("_n")).otherwise(
        F.coalesce(at("_tail", "_end"), F.raise_error(F.lit("no common token boundary"))))
    since = F.when(F.col("_chunk") == 0, F.lit(0)).otherwise(at("_head", "_start"))
    sums = spliced.groupBy("_row").agg(F.sum(upto - since).alias("n_tokens"))
    spliced_rows = (long.select("_row", "doc_id", "n_bytes").join(sums, "_row")
                    .select("doc_id", "n_bytes", "n_tokens"))
    return short.unionByName(spliced_rows).withColumn(
        "over_limit", F.col("n_tokens") > limit)
