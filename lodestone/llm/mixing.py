"""Mix sources to target weights.

The words of a source form one stream, cut into blocks of a fixed length. Every output shard draws
how many of its slots each source fills (a multinomial draw conditioned on the quotas, split over
the shards by a binary tree, so that any shard can be drawn alone and again after a lost task).
The k-th slot of a source maps to a block through the source's pseudorandom permutation of its
block numbers, a new permutation for each pass, and slots meet blocks in a join on that number.

Defined cases: a null or empty text has no words and takes no part; a null source is a source of
its own, ordered last; repeated rows are documents of their own; an empty table gives no rows;
further columns of the input, whatever their names, are carried by :func:`mixed_documents` and
ignored otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.carry import CARRIED, packed, unpacked
from lodestone.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 1024
#: More sources than this are refused: the table of quotas goes to every task.
MAX_SOURCES = 1_000_000
_EXACT = 10**9


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Targets of the sources in a table ``_source, source_size`` (one row for each source).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all
    words. No target is above ``most`` times its source; the excess is shared out again.
    """
    order = Window.orderBy(F.col("_source").isNull(), F.col("_source"))
    place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("_w", place).withColumn("_cap", F.col("source_size") * float(most))
    ranked = ranked.withColumn("_full", F.col("_cap") / F.col("_w"))
    by_full = Window.orderBy("_full", F.col("_source").isNull(), "_source")
    before = by_full.rowsBetween(Window.unboundedPreceding, -1)
    after = by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * float(share)
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    ranked = ranked.withColumn("_level", level)
    water = F.min(F.when(F.col("_full") >= F.col("_level"),
                         F.struct("_full", F.col("_source").isNull().alias("n"), "_source",
                                  "_level"))).over(everything)["_level"]
    return (ranked.withColumn("_water", water)
            .select("_source", "source_size",
                    F.least(F.col("_cap"), F.coalesce(F.col("_water"), F.col("_level"))
                            * F.col("_w")).alias("target")))


def _key() -> Column:
    return F.concat(F.when(F.col("_source").isNull(), "n").otherwise("s"),
                    F.coalesce("_source", F.lit("")))


def sized_documents(docs: DataFrame) -> DataFrame:
    """The documents with ``_source``, ``_key`` (its name, null apart), ``_size`` (words) and
    ``_hash`` of the row."""
    plain = [F.col(c) for c in docs.columns if c in ("doc_id", "text", "lang", "n_chars")]
    if CARRIED in docs.columns:
        plain.append(F.to_json(CARRIED))
    return docs.withColumns({
        "_source": F.col("source").cast("string"),
        "_size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "_hash": F.xxhash64(*plain),
    }).withColumn("_key", _key())


def placed_documents(rows: DataFrame, buckets: int) -> DataFrame:
    """Sized rows with their places: ``_bucket, _row`` (which name the row) and ``_offset``, the
    words before it in its source's stream.

    A source is dealt into buckets by a hash of the row; offsets are sums within a bucket after
    the sums of the buckets before it, so no task holds a source.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(buckets)).cast("int"))
    sums = dealt.groupBy("_key", "_bucket").agg(F.sum("_size").alias("_sum"))
    earlier = (Window.partitionBy("_key").orderBy("_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("_key", "_bucket",
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_key", "_bucket").orderBy("_hash", "doc_id", "_size")
    return (dealt.withColumn("_row", F.row_number().over(inside))
            .withColumn("_within", F.sum("_size").over(
                inside.rowsBetween(Window.unboundedPreceding, -1)))
            .join(starts, ["_key", "_bucket"])
            .withColumn("_offset", F.col("_start") + F.coalesce("_within", F.lit(0)))
            .drop("_start", "_within"))


def _seed(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


def _split(counts: np.ndarray, size: int, seed: int) -> np.ndarray:
    """How many of ``size`` slots drawn from ``counts`` fall to each source."""
    total = int(counts.sum())
    if total < _EXACT:
        return np.random.default_rng(seed).multivariate_hypergeometric(
            counts, size, method="marginals")
    share = np.floor(counts * (size / total)).astype(np.int64)  # noise is below one in 10**4 here
    rest = size - int(share.sum())
    share[np.argsort(-(counts - share), kind="stable")[:rest]] += 1
    return share


def shard_counts(quotas: np.ndarray, shards: int, shard: int, slots: int,
                 seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots per source of one shard, and those of all shards before it.

    Walks from the root of a binary tree over the shards to the shard, drawing at each node how
    its slots split between the halves.
    """
    total = int(quotas.sum())
    low, high = 0, shards
    counts, before = quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        size = min(total, middle * slots) - low * slots
        left = _split(counts, size, _seed(seed, low, high))
        if shard < middle:
            counts, high = left, middle
        else:
            before, counts, low = before + left, counts - left, middle
    return counts, before


def permuted(index: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 (a Feistel network, walked until in range)."""
    if size <= 1:
        return index.copy()
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(_seed(seed, size, k)) for k in range(6)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            f = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while len(far := np.flatnonzero(out >= size)):
        out[far] = once(out[far])
    return out.astype(np.int64)


def draw_slots(sources: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Every output slot with the block it takes: ``shard, slot, _key, _pass, _block``.

    ``sources`` has ``_key, _blocks`` (blocks of the source) and ``_slots`` (its quota), one row
    for each source. At most ``MAX_SOURCES`` sources are accepted.
    """
    spark = sources.sparkSession
    quota = sources.filter("_slots > 0").select("_key", "_blocks", "_slots").limit(
        MAX_SOURCES + 1).toPandas().sort_values("_key", ignore_index=True)
    if len(quota) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    keys = quota["_key"].to_numpy()
    blocks, slots = quota["_blocks"].to_numpy(np.int64), quota["_slots"].to_numpy(np.int64)
    total = int(slots.sum())
    shards = -(-total // shard_slots)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"].tolist():
                counts, before = shard_counts(slots, shards, shard, shard_slots, seed)
                which = np.repeat(np.arange(len(counts)), counts)
                nth = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts)
                                      ]).astype(np.int64)
                block, turn = np.zeros(len(which), np.int64), nth // blocks[which]
                for k, t in {*zip(which.tolist(), turn.tolist())}:
                    here = (which == k) & (turn == t)
                    block[here] = permuted(nth[here] % blocks[k], int(blocks[k]),
                                           _seed(seed, keys[k], t))
                order = np.random.default_rng(_seed(seed, "order", shard)).permutation(len(which))
                yield pd.DataFrame({"shard": shard, "slot": np.arange(len(which)),
                                    "_key": keys[which[order]], "_pass": turn[order],
                                    "_block": block[order]})

    schema = "shard long, slot long, _key string, _pass long, _block long"
    if not shards:
        return spark.createDataFrame([], schema)
    tasks = min(shards, max(spark.sparkContext.defaultParallelism, shards // 64))
    return spark.range(0, shards, 1, tasks).mapInPandas(fill, schema)


class Mixture:
    """A drawn mixture: ``documents`` (placed, with targets) and ``pieces`` (what each slot takes).

    ``pieces``: ``shard, slot, _pass, _key, _block`` and the part of a document in that block:
    ``_bucket, _row, _start, _length`` (words). A block may hold several documents.
    """

    def __init__(self, docs: DataFrame, share: float = SHARE, most: int = MOST,
                 weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS,
                 seed: int = 0):
        sized = sized_documents(docs)
        slim = sized.select("doc_id", "_source", "_key", "_size", "_hash")
        slim = cut_lineage(slim)
        n = slim.count()
        placed = placed_documents(slim, max(64, min(4096, n // 128)))
        sizes = slim.groupBy("_key", "_source").agg(F.sum("_size").alias("source_size"))
        targets = source_targets(sizes.drop("_key"), share, most, weights)
        blocks = F.ceil(F.col("source_size") / block_words)
        sources = (targets.withColumn("_key", _key()).withColumn("_blocks", blocks)
                   .withColumn("_slots", F.when(F.col("source_size") > 0, F.least(
                       F.col("_blocks") * most,
                       F.round(F.col("_blocks") * F.col("target") / F.col("source_size"))
                       .cast("long"))).otherwise(0)))
        self.sized = sized
        self.sources = cut_lineage(sources)
        self.documents = placed.join(self.sources.select("_key", "source_size", "target"), "_key")
        self.slots = draw_slots(self.sources, seed).hint("merge")  # grows with the documents
        self.block_words = block_words

    def parts(self) -> DataFrame:
        """The part of each document in each block: one row for each pair that meets."""
        width = F.lit(self.block_words)
        end = F.col("_offset") + F.col("_size")
        first = F.floor(F.col("_offset") / width)
        last = F.floor((end - 1) / width)
        return (self.documents.filter("_size > 0")
                .select("_key", "_bucket", "_row", "_offset", end.alias("_end"),
                        F.explode(F.sequence(first, last)).alias("_block"))
                .select("_key", "_bucket", "_row", "_block",
                        (F.greatest(F.col("_block") * width, F.col("_offset"))
                         - F.col("_offset")).alias("_start"),
                        (F.least((F.col("_block") + 1) * width, F.col("_end"))
                         - F.greatest(F.col("_block") * width, F.col("_offset")))
                        .alias("_length")))

    def pieces(self) -> DataFrame:
        return self.slots.join(self.parts(), ["_key", "_block"])

    def taken(self) -> DataFrame:
        """``documents`` with ``taken``, the words the mixture takes from each, repeats counted."""
        row = ["_key", "_bucket", "_row"]
        words = self.pieces().groupBy(*row).agg(F.sum("_length").alias("_taken"))
        return (self.documents.join(words, row, "left")
                .withColumn("taken", F.coalesce("_taken", F.lit(0)).cast("long")).drop("_taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as documents: for each pass that takes words of a document, a row with them.

    The columns are those of ``docs``; ``text`` holds the words of the blocks taken, in order and
    with the white space after them, and ``n_chars``, where present, its new length.
    """
    columns, docs = docs.columns, packed(docs)
    mixture = Mixture(docs, **options)
    row = ["_key", "_bucket", "_row"]
    spans = (mixture.pieces().groupBy(*row, "_pass")
             .agg(F.array_sort(F.collect_list(F.struct("_start", "_length"))).alias("_spans")))
    # Rows alike in key, hash and id are equal: one of them stands for all, with all their takes.
    takes = (mixture.documents.join(spans, row)
             .groupBy("_key", "_hash", F.col("doc_id").alias("_id"))
             .agg(F.collect_list("_spans").alias("_takes")))
    alike = Window.partitionBy("_key", "_hash", "doc_id").orderBy("_size")
    whole = (mixture.sized.withColumn("_nth", F.row_number().over(alike)).filter("_nth = 1"))
    takes = takes.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "_id", "_takes")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    cut = (whole.join(takes, (F.col("_key") == F.col("_k")) & (F.col("_hash") == F.col("_h"))
                      & F.col("doc_id").eqNullSafe(F.col("_id")))
           .withColumn("_words", words).withColumn("_take", F.explode("_takes"))
           .withColumn("text", F.concat_ws("", F.flatten(F.transform(
               "_take", lambda s: F.slice("_words", (s["_start"] + 1).cast("int"),
                                          s["_length"].cast("int")))))))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return unpacked(cut, columns)
