"""Remove byte strings that occur more than once: a sparse suffix array by distributed merge sort.

A window is the 200 bytes that begin at a position. It recurs if it begins at any other position
too, in the same document or another one; all bytes of recurring windows are removed. Sorting the
suffixes at every byte is not needed:

* Every window names an anchor, the leftmost of its 64-byte grams with the least hash. Equal windows
  name the same place inside them. Consecutive windows with one anchor form a block.
* A window can recur only if the gram of its block does. Grams are counted first; documents
  without a repeated gram are done.
* Suffixes at the beginnings of the other blocks are sorted, and, from their ends, the reversed
  prefixes. Where a repeated passage covers several blocks, every block of it shares its beginning
  or its end with another one, so the longest common prefixes with the neighbours in sorted order
  tell all its windows.
* What is left are windows in the middle of a block. Sorting the texts to the right and to the left
  of the anchors tells how far any other place shares them; a window that reaches beyond is unique.
* The windows then left, if their hash is not unique among the windows of blocks with the same
  grams, are sorted as suffixes of their own.

Each sort is a merge sort: runs are sorted in their tasks, exchanged front-coded, and combined by a
loser tree that never re-compares known prefixes. Suffixes meet by a hash of their first 200 bytes
(100 for the anchors): only those that share them matter to each other. Documents come into runs by
their least repeated gram, so near copies meet there; equal strings of one run travel as one.

Defined cases: a null text is empty; repeated rows and null ids are documents of their own (and
repeat each other); texts shorter than a window are kept whole; an empty table gives no rows;
further columns are ignored. Hashes only choose what is sorted; removal rests on compared bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.merge import compare, decoded, front_coded, merged
from lodestone.llm.words import to_bytes
from lodestone.session import scratch_path

WINDOW = 200
GRAM = 64
RUN_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
_CHUNK = 1 << 15  # positions handled at once: small arrays stay in the cache
_ZSTD = zstandard.ZstdCompressor(level=3)
_BYTE = np.random.default_rng(2_718).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
_C = 0x9E3779B97F4A7C15
_LONGEST = 3 * _CHUNK
_POWER = np.cumprod(np.append(np.uint64(1), np.full(_LONGEST, _C, np.uint64)))
_INVERSE = np.cumprod(np.append(np.uint64(1), np.full(_LONGEST, pow(_C, -1, 2**64), np.uint64)))


def _rolling(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    values = _BYTE.take(data)
    values *= _POWER[:len(data)]
    np.cumsum(values, out=out[1:])
    return out


def _hashes(rolling: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes; equal strings have equal hashes anywhere."""
    n = len(rolling) - width
    out = rolling[width:] - rolling[:n]
    out *= _INVERSE[:n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(_C)
    return out


def window_hashes(data: np.ndarray, first: int, count: int, window: int = WINDOW) -> np.ndarray:
    """Hashes of ``count`` windows from position ``first``."""
    return _hashes(_rolling(data[first:first + count + window - 1]), window)


def all_window_hashes(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hashes of all windows of a text."""
    total = len(data) - window + 1
    return np.concatenate([window_hashes(data, at, min(_CHUNK, total - at), window)
                           for at in range(0, total, _CHUNK)])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values) - width + 1
    fill = -len(values) % width
    grid = np.append(values, np.full(fill, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n], out=behind[:n])


def blocks(data: np.ndarray, window: int = WINDOW,
           gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, place of the anchor and its gram's hash, for each block."""
    total = len(data) - window + 1
    if total <= 0:
        return (*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))
    width = window - gram + 1
    low = np.uint64((1 << 20) - 1)
    firsts, anchors, grams, last = [], [], [], -1
    for at in range(0, total, _CHUNK):
        count = min(_CHUNK, total - at)
        found = _hashes(_rolling(data[at:at + count + window - 1]), gram)
        # The place in the low bits makes the leftmost of equal hashes the least.
        keys = (found & ~low) | np.arange(len(found), dtype=np.uint64)
        place = (_least(keys, width) & low).astype(np.int64)
        new = np.flatnonzero(np.append(place[0] + at != last, place[1:] != place[:-1]))
        firsts.append(new + at)
        anchors.append(place[new] + at)
        grams.append(found[place[new]])
        last = int(place[-1]) + at
    first = np.concatenate(firsts)
    return first, np.diff(first, append=total), np.concatenate(anchors), np.concatenate(grams)


def blocks_of(texts: list[np.ndarray], window: int = WINDOW, gram: int = GRAM) -> tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first window, count, anchor and gram of the blocks of several short texts.

    They are hashed end to end; windows across two texts are left out, and no other window looks
    at another text.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.concatenate(texts)
    width, low = window - gram + 1, np.uint64((1 << 20) - 1)
    base = np.cumsum(sizes) - sizes
    counts = np.maximum(0, sizes - window + 1)
    text = np.repeat(np.arange(len(texts)), counts)
    if not len(text):
        return (*[np.zeros(0, np.int64)] * 4, np.zeros(0, np.uint64))
    at = np.arange(len(text)) + np.repeat(base - np.cumsum(counts) + counts, counts)
    found = _hashes(_rolling(data), gram)
    keys = (found & ~low) | np.arange(len(found), dtype=np.uint64)
    place = (_least(keys, width)[at] & low).astype(np.int64)
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    own = text[new]
    return (own, at[new] - base[own], np.diff(new, append=len(text)), place[new] - base[own],
            found[place[new]])


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, compressed."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    # Spark drops the shuffle files of a finished step when the driver collects its garbage.
    df.sparkSession._jvm.System.gc()
    out = df.sparkSession.read.parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables on which nothing depends any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _repeated_grams(docs: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The stored table of all blocks, and ``_key, _blocks, _near``: each text's blocks with repeated grams, and the least gram."""
    schema = pa.schema([("g", pa.int64()), ("_key", pa.int64()), ("first", pa.int64()),
                        ("count", pa.int32()), ("anchor", pa.int64())])

    def rows(keys: np.ndarray, first, count, anchor, grams) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(grams.view(np.int64)), pa.array(keys), pa.array(first),
             pa.array(count, pa.int32()), pa.array(anchor)], schema=schema)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held, size = [], [], 0
            for key, text in zip(batch["_key"].to_pylist(), batch["text"]):
                data = np.frombuffer(to_bytes(text.as_py()), np.uint8)
                if len(data) > _CHUNK:
                    found = blocks(data, window, gram)
                    yield rows(np.full(len(found[0]), key), *found)
                    continue
                keys.append(key)
                held.append(data)
                size += len(data)
                if size > _CHUNK:
                    own, *found = blocks_of(held, window, gram)
                    yield rows(np.array(keys, np.int64)[own], *found)
                    keys, held, size = [], [], 0
            if held:
                own, *found = blocks_of(held, window, gram)
                yield rows(np.array(keys, np.int64)[own], *found)

    long = docs.filter(F.octet_length("text") >= window).select("_key", "text")
    found = stored(long.mapInArrow(
        _joined(places), "g long, _key long, first long, count int, anchor long"), "suffix-blocks")
    often = found.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g")
    # Equal texts share a key and have equal blocks: sets, so that copies do not pile up.
    return found, (found.join(often.hint("merge"), "g").groupBy("_key")
            .agg(F.collect_set(F.struct("first", "count", "anchor", "g")).alias("_blocks"),
                 F.min("g").alias("_near")))


def _joined(make, rows: int = 50_000):
    """Combine the small batches that ``make`` yields into larger ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in make(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return run


def _kept(text: bytes, spans: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, and the digest of the rest."""
    if not len(spans):
        return 0, 0, hashlib.sha256(text).hexdigest()
    step = np.zeros(len(text) + 1, np.int32)
    np.add.at(step, spans[:, 0], 1)
    np.add.at(step, spans[:, 1], -1)
    gone = np.cumsum(step[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    rest = np.frombuffer(text, np.uint8)[~gone]
    return int(gone.sum()), runs, hashlib.sha256(rest.tobytes()).hexdigest()


_BLOCK = "array<struct<first:long,count:int,anchor:long,g:long>>"
_block_type = pa.list_(pa.struct([("first", pa.int64()), ("count", pa.int32()),
                                  ("anchor", pa.int64()), ("g", pa.int64())]))
_TRIPLES = "run long, spans binary"


def _runs(dirty: DataFrame) -> DataFrame:
    """``ids, texts, blocks``: documents in runs of about ``RUN_BYTES``, as they come."""
    kind = dirty.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def run() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            columns = [table["doc_id"], table["text"], table["_blocks"]]
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), c.chunk(0))
                 for c in columns], ["ids", "texts", "blocks"])

        for batch in batches:
            first = 0
            for k, text in enumerate(batch["text"]):
                size += len(text.as_buffer())
                if size >= RUN_BYTES:
                    held.append(batch.slice(first, k + 1 - first))
                    yield run()
                    held, size, first = [], 0, k + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield run()

    return dirty.select("doc_id", "text", "_blocks").mapInArrow(
        pack, f"ids array<{kind}>, texts array<binary>, blocks array<{_BLOCK}>")


def _sorted_run(items: list[tuple[bytes, int, int]], direction: int, run: int, buckets: int,
                prefix: int, gram: int) -> tuple[dict[int, bytes], list[tuple[int, int, int]]]:
    """Sort a run's strings (string, document, position).

    Returns the front-coded runs by bucket, and what is settled at once: strings that the run holds
    twice or more, as spans (document, from, to).
    """
    items.sort(key=lambda x: x[0])
    settled: list[tuple[int, int, int]] = []
    parts: dict[int, list[tuple[bytes, int, int]]] = {}
    at = 0
    while at < len(items):
        string = items[at][0]
        end = at + 1
        while end < len(items) and items[end][0] == string:
            end += 1
        if end - at > 1:
            settled += [_span(doc, place, len(string), direction, gram)
                        for _, doc, place in items[at:end] if doc >= 0]
        bucket = zlib.crc32(string[:prefix]) % buckets
        # The first stands for all; a negative document says that it needs no answer.
        parts.setdefault(bucket, []).append(
            (string, items[at][1] if end - at == 1 else -1, items[at][2]))
        at = end
    blobs = {}
    for bucket, found in parts.items():
        ids = np.array([(d, p) for _, d, p in found], "<i8")
        blobs[bucket] = (np.array([run, direction, len(found)], "<i8").tobytes()
                         + _ZSTD.compress(ids.tobytes() + front_coded([s for s, _, _ in found])))
    return blobs, settled


def _span(doc: int, place: int, length: int, direction: int, gram: int) -> tuple[int, int, int]:
    """(document, from, to) of a string that begins, or read backwards ends, at ``place``.

    Direction -2 is for strings read backwards from the end of an anchor's gram: (document,
    -1 - anchor, from).
    """
    if direction > 0:
        return doc, place, place + length
    return (doc, place - length, place) if direction == -1 else (
        doc, -1 - place, place + gram - length)


def _merge_blobs(blobs: list[bytes], least: int,
                 gram: int) -> dict[int, list[tuple[int, int, int]]]:
    """Merge the runs of one bucket: spans (document, from, to) by run."""
    spans: dict[int, list[tuple[int, int, int]]] = {}
    for direction in (1, -1, -2):
        streams, owners = [], []
        for blob in blobs:
            run, way, count = np.frombuffer(blob, "<i8", 3).tolist()
            if way == direction:
                body = zstandard.decompress(blob[24:])
                ids = np.frombuffer(body, "<i8", 2 * count).reshape(-1, 2).tolist()
                owners.append([run, iter(ids)])
                streams.append(decoded(body[16 * count:]))
        before: tuple | None = None
        for source, string, shared in merged(streams):
            run, ids = owners[source]
            doc, place = next(ids)
            if before is not None:
                _settle(spans, before, max(before[3], shared), direction, least, gram)
            before = (run, doc, place, shared)
        if before is not None:
            _settle(spans, before, before[3], direction, least, gram)
    return spans


def _settle(spans: dict, entry: tuple, shared: int, direction: int, least: int,
            gram: int) -> None:
    run, doc, place, _ = entry
    if shared >= least and doc >= 0:
        spans.setdefault(run, []).append(_span(doc, place, shared, direction, gram))


def _spans_of(blob_rows: DataFrame, least: int, gram: int = GRAM) -> DataFrame:
    """Exchange and merge: ``run, spans``, packed (document, from, to) of what each string shares
    with a neighbour, if it is at least ``least`` bytes. Strings meet by their first ``least``."""
    def merge(table: pa.Table) -> pa.Table:
        runs: list[int] = []
        packed: list[bytes] = []
        blobs = []
        for run, blob in zip(table["run"].to_pylist(), table["blob"].to_pylist()):
            if run is None:
                blobs.append(blob)
            else:  # settled within its run
                runs.append(run)
                packed.append(blob)
        for run, found in _merge_blobs(blobs, least, gram).items():
            runs.append(run)
            packed.append(np.array(found, "<i8").tobytes())
        return pa.table([pa.array(runs, pa.int64()), pa.array(packed, pa.binary())],
                        ["run", "spans"])

    return blob_rows.groupBy("bucket").applyInArrow(merge, _TRIPLES)


_blob_schema = pa.schema([("bucket", pa.int64()), ("run", pa.int64()), ("blob", pa.binary())])
_BLOBS = "bucket long, run long, blob binary"


def _blob_batch(run: int, groups: list[tuple[int, list]], buckets: int, least: int,
                gram: int = GRAM, known: list[tuple[int, int, int]] = ()) -> pa.RecordBatch:
    """Rows for one run: its blobs by bucket, and what it settles by itself."""
    rows: list[tuple[int, int | None, bytes]] = []
    if known:
        rows.append((run % buckets, run, np.array(known, "<i8").tobytes()))
    for direction, items in groups:
        blobs, settled = _sorted_run(items, direction, run, buckets, least, gram)
        rows += [(bucket, None, blob) for bucket, blob in blobs.items()]
        if settled:
            rows.append((run % buckets, run, np.array(settled, "<i8").tobytes()))
    columns = list(zip(*rows)) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _blob_schema.types)], schema=_blob_schema)


def _triples(parts: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(parts or []), "<i8").reshape(-1, 3)


class _Run:
    """A run's texts and blocks as arrays; positions count from the beginning of the first text."""

    def __init__(self, row: dict, window: int, gram: int):
        self.gram_width = gram
        self.run = row["run"].as_py()
        texts = row["texts"].values if "texts" in row else None
        docs = row["blocks"].values
        self.window = window
        sizes = row["sizes"].values.to_numpy() if texts is None else np.array(
            [len(t.as_buffer()) for t in texts])
        self.base = np.cumsum(sizes) - sizes
        self.total = int(sizes.sum())
        self.texts = texts
        self.doc = np.repeat(np.arange(len(docs)), pc.list_value_length(docs).to_numpy())
        first, count, anchor, gram = docs.flatten().flatten()
        self.first, self.anchor = first.to_numpy(), anchor.to_numpy()
        self.count, self.gram = count.to_numpy().astype(np.int64), gram.to_numpy()
        # Keys of different texts may collide: blocks that lie outside their text are no blocks.
        inside = self.first + self.count - 1 + window <= sizes[self.doc]
        self.doc, self.first, self.count, self.anchor, self.gram = (
            x[inside] for x in (self.doc, self.first, self.count, self.anchor, self.gram))

    def span_mask(self, triples: np.ndarray, shorter: int) -> np.ndarray:
        """Marks the positions of spans (document, from, to), each taken ``shorter`` at its end."""
        step = np.zeros(self.total + 1, np.int32)
        begin = self.base[triples[:, 0]] + triples[:, 1]
        end = self.base[triples[:, 0]] + triples[:, 2] - shorter
        np.add.at(step, begin, 1)
        np.add.at(step, np.maximum(begin, end), -1)
        return np.cumsum(step[:-1]) > 0

    def open_windows(self, told: np.ndarray, reach: np.ndarray | None = None
                     ) -> tuple[np.ndarray, np.ndarray]:
        """Block number and position in its text of every window that may recur unbeknown.

        ``told``: spans known to recur. ``reach``: spans that the texts around the anchors share
        with any other place; a window must lie in what its anchor's two spans make together.
        """
        known = self.span_mask(told, self.window - 1)
        block = np.repeat(np.arange(len(self.first)), self.count)
        place = np.arange(len(block)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        place += self.first[block]
        rest = ~known[self.base[self.doc[block]] + place]
        block, place = block[rest], place[rest]
        if reach is not None:
            low, high = self.reached(reach)
            rest = (place >= low[block]) & (place + self.window <= high[block])
            block, place = block[rest], place[rest]
        return block, place

    def reached(self, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far to the left and to the right each block's anchor can be shared at most."""
        half = self.window // 2
        key = self.base[self.doc] + self.anchor
        order = np.argsort(key)
        # What was not told is less than half a window.
        low, high = self.anchor + self.gram_width - half, self.anchor + half
        ahead, back = reach[reach[:, 1] >= 0], reach[reach[:, 1] < 0]
        slot = order[np.searchsorted(key[order], self.base[ahead[:, 0]] + ahead[:, 1])]
        np.maximum.at(high, slot, ahead[:, 2])
        slot = order[np.searchsorted(key[order], self.base[back[:, 0]] - 1 - back[:, 1])]
        np.minimum.at(low, slot, back[:, 2])
        return low, high


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {name: batch[name][k] for name in batch.schema.names}


def _list(value: pa.Scalar) -> list:
    return value.as_py() or []


def repeated_spans(docs: DataFrame, window: int = WINDOW,
                   gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """The documents without a repeated gram as result rows, and the others as runs.

    A run row: ``run, ids, texts`` and ``found``, packed (document, from, to) of repeated strings.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"),
                        F.xxhash64("text").alias("_key"))
    every, found = _repeated_grams(docs.withColumn("_key", F.xxhash64("text")), window, gram)
    none = F.col("_blocks").isNull()
    parted = stored(
        keyed.join(found.hint("merge"), "_key", "left").select(
            "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(none, F.sha2("text", 256)).alias("kept_sha256"),
            F.when(~none, F.col("text")).alias("text"), "_blocks", "_near", "_key"),
        "suffix-documents")
    discard(every)
    clean = stored(parted.filter("text IS NULL").select("doc_id", "n_bytes", "kept_sha256"),
                   "suffix-clean")
    # Near copies often share their least gram: they come into one run, where equal strings are
    # settled and travel once.
    near = parted.filter("text IS NOT NULL").repartitionByRange("_near", "_key")
    runs = stored(_runs(near.sortWithinPartitions("_near", "_key"))
                  .withColumn("run", F.monotonically_increasing_id())
                  .withColumn("sizes", F.transform("texts", lambda t: F.octet_length(t))),
                  "suffix-runs")
    discard(parted)
    total = runs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"),
                                       lambda n, t: n + t))).first()[0] or 0
    buckets = max(1, -(-total * 4 // BUCKET_BYTES))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                run = _Run(row, window, gram)
                texts = run.texts.to_pylist()
                ahead, back = [], []
                for doc, begin, end in zip(run.doc.tolist(), run.first.tolist(),
                                           (run.first + run.count - 1 + window).tolist()):
                    string = texts[doc][begin:end]
                    ahead.append((string, doc, begin))
                    back.append((string[::-1], doc, end))
                yield _blob_batch(run.run, [(1, ahead), (-1, back)], buckets, window)

    spans = stored(_spans_of(runs.mapInArrow(edges, _BLOBS), window), "suffix-spans")
    told = spans.groupBy("run").agg(F.collect_list("spans").alias("found")).hint("merge")

    def asked(rows: DataFrame, reach: bool) -> DataFrame:
        """``run, grams``: for each run its grams of which any run holds a block with open windows.
        """
        def open_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _rows(batch):
                    run = _Run(row, window, gram)
                    block, _ = run.open_windows(_triples(_list(row["found"])), _triples(
                        _list(row["reach"])) if reach else None)
                    grams, slot = np.unique(run.gram, return_inverse=True)
                    still = np.zeros(len(grams), bool)
                    still[slot[block]] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(grams), run.run)), pa.array(grams),
                         pa.array(still)], ["run", "g", "open"])

        grams = stored(rows.mapInArrow(open_grams, "run long, g long, open boolean"),
                       "suffix-grams")
        wanted = grams.filter("open").select("g").distinct()
        return (grams.select("run", "g").join(wanted.hint("merge"), "g").groupBy("run")
                .agg(F.collect_list("g").alias("grams"))).hint("merge")

    # Windows that neither end of their block has told about. How far can their anchors' texts be
    # shared at all? What is shared less than half a window on one side needs no exact answer.
    half = window // 2
    slim = ["run", "sizes", "blocks"]
    first = asked(runs.select(*slim).join(told, "run", "left"), False)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                run = _Run(row, window, gram)
                texts = run.texts.to_pylist()
                pick = np.flatnonzero(np.isin(run.gram, np.array(_list(row["grams"]), np.int64)))
                ahead, back = [], []
                for doc, begin, at, end in zip(
                        run.doc[pick].tolist(), run.first[pick].tolist(),
                        run.anchor[pick].tolist(),
                        (run.first + run.count - 1 + window)[pick].tolist()):
                    ahead.append((texts[doc][at:end], doc, at))
                    back.append((texts[doc][begin:at + gram][::-1], doc, at))
                yield _blob_batch(run.run, [(1, ahead), (-2, back)], buckets, half, gram)

    reach = stored(_spans_of(runs.join(first, "run").mapInArrow(anchors, _BLOBS), half, gram),
                   "suffix-reach")
    reach = reach.groupBy("run").agg(F.collect_list("spans").alias("reach")).hint("merge")
    second = asked(runs.select(*slim).join(first.select("run"), "run", "left_semi")
                   .join(told, "run", "left").join(reach, "run", "left"), True)
    state = stored(runs.join(second, "run").join(told, "run", "left").join(reach, "run", "left"),
                   "suffix-state")

    def inner(row: dict) -> tuple[_Run, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, position, hash, and whether it is open, of the windows of blocks in play."""
        run = _Run(row, window, gram)
        chosen = np.flatnonzero(np.isin(run.gram, np.array(_list(row["grams"]), np.int64)))
        block, place = run.open_windows(_triples(_list(row["found"])),
                                        _triples(_list(row["reach"])))
        still = np.zeros(run.total + 1, bool)
        still[run.base[run.doc[block]] + place] = True
        count = run.count[chosen]
        doc = np.repeat(run.doc[chosen], count)
        place = np.repeat(run.first[chosen] - np.cumsum(count) + count, count) + np.arange(len(doc))
        values = np.zeros(len(doc), np.uint64)
        edges = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
        for low, high in zip(edges, edges[1:]):  # blocks stand by document
            data = np.frombuffer(run.texts[int(doc[low])].as_buffer(), np.uint8)
            values[low:high] = all_window_hashes(data, window)[place[low:high]]
        return run, doc, place, values, still[run.base[doc] + place]

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                run, _, _, values, still = inner(row)
                values, slot, counts = np.unique(values, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), run.run)), pa.array(values.view(np.int64)),
                     pa.array(counts), pa.array(np.bincount(slot, still, len(values)) > 0)],
                    ["run", "h", "n", "open"])

    seen = stored(state.mapInArrow(hashes, "run long, h long, n long, open boolean"),
                  "suffix-windows")
    again = (seen.groupBy("h").agg(F.sum("n").alias("m"), F.max("open").alias("o"))
             .filter("m > 1 AND o").select("h"))
    listed = (seen.select("run", "h").join(again.hint("merge"), "h").groupBy("run")
              .agg(F.collect_list("h").alias("windows"))).hint("merge")

    def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One string for each hash that recurs; open windows equal to it are settled at once."""
        for batch in batches:
            for row in _rows(batch):
                run, doc, place, values, still = inner(row)
                known = np.array(_list(row["windows"]), np.int64).view(np.uint64)
                pick = np.flatnonzero(np.isin(values, known))
                pick = pick[np.lexsort((~still[pick], values[pick]))]  # open ones first
                new = np.append(True, values[pick][1:] != values[pick][:-1])[:len(pick)]
                texts = run.texts.to_pylist()
                items, settled, string = [], [], b""
                for first, d, p, asks in zip(new.tolist(), doc[pick].tolist(),
                                             place[pick].tolist(), still[pick].tolist()):
                    if first:
                        string, held = texts[d][p:p + window], (d, p) if asks else None
                        items.append((string, d if asks else -1, p))
                    elif asks or held:
                        if texts[d][p:p + window] != string:  # two strings of one hash
                            items.append((texts[d][p:p + window], d if asks else -1, p))
                            continue
                        settled += [(*x, x[1] + window) for x in (held, (d, p) if asks else None)
                                    if x]
                        held = None
                yield _blob_batch(run.run, [(1, items)], buckets, window, gram, settled)

    more = stored(_spans_of(state.join(listed, "run").mapInArrow(middles, _BLOBS), window),
                  "suffix-middles")
    discard(seen, state)
    both = spans.union(more).groupBy("run").agg(F.collect_list("spans").alias("found"))
    return clean, runs.select("run", "ids", "texts").join(both.hint("merge"), "run", "left")


def _by_doc(triples: np.ndarray, count: int) -> list[np.ndarray]:
    triples = triples[np.argsort(triples[:, 0], kind="stable")]
    edges = np.searchsorted(triples[:, 0], np.arange(count + 1))
    return [triples[a:b, 1:] for a, b in zip(edges, edges[1:])]


def deduplicated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each document."""
    clean, told = repeated_spans(docs, window, gram)
    kind = clean.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, parts in zip(batch["ids"], batch["texts"].to_pylist(),
                                         batch["found"].to_pylist()):
                rows = [_kept(t, s) for t, s in zip(texts, _by_doc(_triples(parts), len(texts)))]
                gone, runs, digest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    whole = clean.select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                         F.lit(0).cast("long").alias("n_spans"), "kept_sha256")
    return whole.unionByName(told.mapInArrow(remove, schema))
