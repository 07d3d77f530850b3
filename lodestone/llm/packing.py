"""Pack tokenised documents into windows of a fixed capacity by multiway differencing.

Each document is tokenised whole, closed with a separator id and cut: full windows first, then the
rest, with its last eighth and the last quarter of that as pieces of their own, which fill the gaps
of others. The rests are dealt by hash into batches that fill about ``BATCH_WINDOWS`` windows, and each batch is partitioned by the Karmarkar-Karp method: the
two partial partitions with the largest spreads are merged with opposing order (fullest with
emptiest) until one is left. If a window then exceeds the capacity, the batch gets one window more.

Defined cases: a null or empty text has the separator alone; repeated rows and null ids are
documents of their own; special strings inside a text become what the tokenizer makes of them by
default; a huge text is tokenised in slices cut at points where the tokenizer's split is proven the
same; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

CAPACITY = 1024
BATCH_WINDOWS = 64
WHOLE = 64  # a shorter rest is not cut
SEPARATOR = 0
SLICE = 1 << 20
VOCABULARY = "byte_bpe_50k"
#: Fixed values of the public vocabulary: its one special string.
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _encoders(name: str):
    """The tokenizer, and a faster encoder with the same vocabulary for texts without specials."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json")), fast


#: Before a single space between two other characters no token of this vocabulary can cross: the
#: split pattern starts a new match there and neither side looks past it.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def text_slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in slices of about ``size`` characters, cut only at safe points."""
    at = 0
    while at < len(text):
        found = _SAFE.search(text, at + size) if at + size < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a whole text as the tokenizer gives them, without added special tokens."""
    slow, fast = _encoders(vocabulary)
    if not text:
        return np.zeros(0, "<u4")
    parts = [slow.encode(part, add_special_tokens=False).ids if SPECIAL in part
             else fast.encode_ordinary(part) for part in text_slices(text)]
    return np.array(parts[0] if len(parts) == 1 else [x for p in parts for x in p], "<u4")


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of n tokens."""
    whole, rest = divmod(n, capacity)
    found = [(k * capacity, capacity) for k in range(whole)]
    if rest:
        edges = [0, rest] if rest < WHOLE else [0, rest - rest // 8, rest - rest // 32, rest]
        found += [(whole * capacity + a, b - a) for a, b in zip(edges, edges[1:])]
    return found


def tokenised_pieces(docs: DataFrame, capacity: int = CAPACITY,
                     separator: int = SEPARATOR, vocabulary: str = VOCABULARY,
                     keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and, on request, ``ids`` of every piece."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (
        ", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            ids: list[np.ndarray] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                found = np.append(token_ids(text.as_py(), vocabulary), np.uint32(separator))
                found = found.astype("<u4")
                for start, length in cuts(len(found), capacity):
                    part = found[start:start + length]
                    for column, value in zip(rows, (doc_id, start, length,
                                                    zlib.crc32(part.tobytes()), len(found))):
                        column.append(value)
                    if keep_ids:
                        ids.append(part.astype(np.int32))
            columns = [pa.array(c, pa.int64()) for c in rows]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Partition the items into ``windows`` near-equal sets: the Karmarkar-Karp method.

    A partial partition is its non-empty sets, fullest first, and the spread between its fullest
    and its emptiest set. Only differences matter, so the emptiest set's sum is taken off.
    """
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = []
    for i, size in enumerate(sizes):
        sets = [(size, [i])]
        heap.append((-size if windows > 1 else 0, i, sets))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, order, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        meet = len(a) + len(b) - windows
        if meet <= 0:
            merged = a + b
        else:
            # The last `meet` sets of each side share windows, smallest of one with largest of the
            # other among all: pad in thought with empty sets, then add the two in opposing order.
            lone_a, lone_b = windows - len(b), windows - len(a)
            pairs = zip(a[lone_a:], reversed(b[lone_b:]))
            merged = a[:lone_a] + b[:lone_b] + [(x + y, p + q) for (x, p), (y, q) in pairs]
        merged.sort(key=lambda s: -s[0])
        low = merged[-1][0] if len(merged) == windows else 0
        if low:
            merged = [(s - low, items) for s, items in merged]
        heapq.heappush(heap, (-merged[0][0], order, merged))
    return [items for _, items in heap[0][2]] if heap else []


def fill_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Sets of items of at most ``capacity``: as few windows as differencing can make fit."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = differencing(sizes, windows)
        if all(sum(sizes[i] for i in s) <= capacity for s in sets):
            return sets
        windows += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY,
         batch_windows: int = BATCH_WINDOWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence is above ``capacity`` tokens.

    ``pieces`` needs ``doc_id, start, length, ids_crc32``; each is at most ``capacity`` long.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    batches = max(1, -(-total // (capacity * batch_windows)))
    schema = pieces.schema.simpleString()[len("struct<"):-1]
    names = pieces.columns

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"),
                               ("ids_crc32", "ascending"), ("length", "ascending")])
        length = group["length"].to_numpy()
        batch = group["_batch"][0].as_py()
        part = np.flatnonzero(length < capacity)
        sets = [[int(i)] for i in np.flatnonzero(length >= capacity)]
        sets += [[int(part[i]) for i in s]
                 for s in fill_windows([int(x) for x in length[part]], capacity)]
        window, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for k, members in enumerate(sets):
            ends = np.cumsum(length[members])
            window[members] = k
            offset[members] = ends - length[members]
        return (group.select(names)
                .append_column("sequence_id", pa.array((batch << 24) + window))
                .append_column("offset", pa.array(offset)))

    dealt = pieces.withColumn("_batch", F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(batches)).cast("long"))
    return dealt.groupBy("_batch").applyInArrow(
        place, f"{schema.replace(':', ' ')}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, **options) -> DataFrame:
    """Documents to packed pieces; the pieces are cut once and kept in the shared folder."""
    return pack(cut_lineage(tokenised_pieces(docs, **options)))
