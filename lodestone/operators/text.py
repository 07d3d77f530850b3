"""Term counts, tf-idf weights per group, lexical richness, topic models."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from lodestone.functions.text import (LONG_WORD, WORD, bilingual_stop_words, english_stop_words,
                                      neighbours, words)
from lodestone.operators.window import top_n_per_group
from lodestone.session import cut_lineage

_CHUNK = 1 << 21  # tokens of a chunk of rows


def group_terms(df: DataFrame, group: str, tokens: Column,
                stop: Sequence[str] = ()) -> DataFrame:
    """Term counts per group, ``stop`` words left out: ``group``, ``term``, ``tf``. The group's
    text is never put together; counts are summed inside the tasks first.

    The null test drops nothing. It is what a later join on the terms would add to its own copy
    of this plan; stated here, all copies are alike and share one shuffle.
    """
    return (df.select(group, F.explode(tokens).alias("term"))
            .filter(F.col("term").isNotNull() & F.col(group).isNotNull() & _wanted(stop))
            .groupBy(group, "term").agg(F.count(F.lit(1)).alias("tf")))


def _wanted(stop: Sequence[str]) -> Column:
    return ~F.col("term").isin(*stop) if stop else F.lit(True)


def top_terms(df: DataFrame, text: str, k: int = 100, pattern: str = LONG_WORD,
              stop: Sequence[str] | None = None) -> DataFrame:
    """Corpus term frequencies, commonest first."""
    stop = bilingual_stop_words() if stop is None else stop
    return (df.select(F.explode(words(text, pattern)).alias("term"))
            .filter(_wanted(stop)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("term")).limit(k))


def vocabulary(counts: DataFrame, size: int, min_df: int = 1) -> DataFrame:
    """The ``size`` commonest terms of (unit, term, tf) rows: ``term``, ``df``."""
    return (counts.groupBy("term")
            .agg(F.sum("tf").alias("_cf"), F.count(F.lit(1)).alias("df"))
            .filter(F.col("df") >= min_df)
            .orderBy(F.desc("_cf"), F.asc("term")).limit(size).select("term", "df"))


def _smooth_idf(n: Column, df: Column) -> Column:
    return F.ln((n + 1) / (df + 1)) + 1


def _unit_terms(df: DataFrame, group: str, text: str, vocab: int, stop: Sequence[str]) -> DataFrame:
    """The :func:`group_terms` of words and word pairs, without pairs that cannot be among the ``vocab``
    commonest terms.

    No pair is commoner than either of its words. Words are therefore counted first, and only neighbours
    that both reach the frequency of the ``vocab``-th word are paired; most different pairs of a large
    corpus are never made. Should very many words tie at that frequency, only the first word is tested:
    it must be one of the ``vocab`` first itself, as it also goes before its pairs by name.
    """
    rows = df.filter(F.col(group).isNotNull()).select(group, text)
    single = cut_lineage(group_terms(rows, group, words(text, WORD), stop))
    by_count = single.groupBy("term").agg(F.sum("tf").alias("_cf"))
    first = by_count.orderBy(F.desc("_cf"), F.asc("term")).limit(vocab).collect()
    if not first:
        return single
    lead = {r["term"] for r in first}
    floor = first[-1]["_cf"] if len(first) == vocab else 1
    tied = by_count.filter(F.col("_cf") == floor).select("term").limit(vocab + 1).collect()
    follow = lead.union(r["term"] for r in tied) if len(tied) <= vocab else None

    def marked(x: Column) -> Column:
        return F.when(x.isin(*follow), x) if follow else x

    def pair(a: Column, b: Column) -> Column:
        both = F.concat(a, F.lit(" "), b)  # null if one is
        return both if follow else F.when(a.isin(*lead), both)

    kept = rows.select(group, F.transform(words(text, WORD, stop), marked).alias("_tokens"))
    return single.unionByName(group_terms(kept, group, neighbours(F.col("_tokens"), pair)))


def term_weights(df: DataFrame, group: str, text: str, vocab: int = 1500, top: int = 15,
                 stop: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """The heaviest terms of each group: tf * (ln((1+N)/(1+df)) + 1), scaled to unit length per
    group, over the ``vocab`` commonest words and word pairs of the corpus."""
    stop = english_stop_words() if stop is None else stop
    counts = _unit_terms(df, group, text, vocab, stop)
    groups = df.agg(F.countDistinct(group)).scalar()
    weighted = (counts.join(vocabulary(counts, vocab), "term")
                .withColumn("_w", F.col("tf") * _smooth_idf(groups, F.col("df"))))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(group)))
    scored = weighted.select(group, "term", F.round(F.col("_w") / length, digits).alias("score"))
    return top_n_per_group(scored, [group], [F.desc("score"), F.asc("term")], top, rank="rank")


def lexical_richness(df: DataFrame, doc: str, text: str, vocab: int = 3000,
                     stop: Sequence[str] | None = None) -> DataFrame:
    """Sum of a document's unit-length tf-idf weights: ``doc``, ``richness``.

    A document without vocabulary terms scores 0.
    """
    stop = english_stop_words() if stop is None else stop
    counts = group_terms(df.select(doc, text), doc, words(text, WORD), stop)
    total = df.agg(F.count(F.lit(1))).scalar()
    weighted = (counts.join(vocabulary(counts, vocab), "term")
                .withColumn("_w", F.col("tf") * _smooth_idf(total, F.col("df"))))
    sums = weighted.groupBy(doc).agg(
        (F.sum("_w") / F.sqrt(F.sum(F.col("_w") * F.col("_w")))).alias("_r"))
    return (df.select(doc).join(sums, doc, "left")
            .select(doc, F.coalesce("_r", F.lit(0.0)).alias("richness")))


def _numbered(sorted_rows: DataFrame, name: str) -> DataFrame:
    """Add the place of each row, from 0, to rows that were sorted just before."""
    placed = cut_lineage(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)  # the partition; the bits below count within it
    ahead = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")
    ahead = ahead.select("_p", before.alias("_before"))
    inside = F.col("_id") - F.shiftleft(F.col("_p"), 33)
    return (placed.join(F.broadcast(ahead), part == F.col("_p"))
            .withColumn(name, F.col("_before") + inside).drop("_id", "_p", "_before"))


def count_vectors(df: DataFrame, key: str, text: str, vocab: int | None = None, min_df: int = 5,
                  stop: Sequence[str] = (), name: str = "counts") -> DataFrame:
    """Each row's counts of the corpus's words, as a sparse vector: ``key``, ``name``.

    The commonest word has index 0. Words in fewer than ``min_df`` rows are left out; ``vocab`` keeps
    only the commonest on request. The words are numbered and looked up by joins: they never meet on
    the driver, however many they are. Rows are counted in chunks, and what is stored and shuffled is each
    chunk's different words, once, and its rows' counts as packed numbers; tokens and texts are not.
    """
    kind = df.select(key).schema[0].dataType
    stored = (StructType().add("_keys", ArrayType(kind)).add("_packed", BinaryType())
              .add("_terms", ArrayType(StringType())).add("_dfs", ArrayType(LongType()))
              .add("_cfs", ArrayType(LongType())))
    chunks = cut_lineage(
        df.select(F.col(key).alias("_key"), words(text, WORD, stop).alias("_tokens"))
        .mapInArrow(_chunks, stored).withColumn("_chunk", F.monotonically_increasing_id()))
    counts = chunks.select("_chunk", F.posexplode(F.arrays_zip("_terms", "_dfs", "_cfs")).alias("_at", "_t"))
    counts = counts.select("_chunk", "_at", F.col("_t._terms").alias("term"), "_t._dfs", "_t._cfs")
    terms = (counts.groupBy("term").agg(F.sum("_cfs").alias("_cf"), F.sum("_dfs").alias("_df"))
             .filter(F.col("_df") >= min_df).orderBy(F.desc("_cf"), F.asc("term")))
    terms = _numbered(terms.select("term"), "_i")
    if vocab is not None:
        terms = terms.filter(F.col("_i") < vocab)
    size = terms.count()
    found = (counts.select("_chunk", "_at", "term").join(terms, "term").groupBy("_chunk")
             .agg(F.collect_list(F.struct("_at", "_i")).alias("_f")))
    return (chunks.select("_chunk", "_keys", "_packed").join(found, "_chunk", "left")
            .select("_keys", "_packed", F.col("_f._at").alias("_at"), F.col("_f._i").alias("_i"))
            .mapInArrow(_renumbered(size, name), StructType().add("_key", kind).add(name, VectorUDT()))
            .withColumnRenamed("_key", key))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of rows (``_key``, ``_tokens``): keys, packed counts, different words, and of each word the
    number of rows and its occurrences."""
    for batch in batches:
        lengths = pc.list_value_length(batch["_tokens"]).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(lengths) - lengths) // _CHUNK
        ends = np.flatnonzero(np.diff(group, append=-1)) + 1
        for start, end in zip([0, *ends], ends):
            n = lengths[start:end]
            part = batch.slice(start, end - start)
            coded = part["_tokens"].flatten().dictionary_encode()
            width = max(1, len(coded.dictionary))
            row = np.repeat(np.arange(len(n)), n)
            code, tf = np.unique(row * width + coded.indices.to_numpy(), return_counts=True)
            at = code % width
            different = np.bincount(code // width, minlength=len(n))
            rows_of = np.bincount(at, minlength=width)[:len(coded.dictionary)]
            occurrences = np.bincount(at, tf, width)[:len(coded.dictionary)].astype(np.int64)
            # Places ascend within a row; their differences are small.
            packed = [_packed(x) for x in (different, np.diff(at, prepend=0), tf)]
            yield pa.RecordBatch.from_arrays(
                [_one(part["_key"]), pa.array([b"".join(packed)], pa.binary()), _one(coded.dictionary),
                 _one(pa.array(rows_of, pa.int64())), _one(pa.array(occurrences, pa.int64()))],
                ["_keys", "_packed", "_terms", "_dfs", "_cfs"])


def _renumbered(size: int, name: str):
    """The rows of chunks with their vectors of ``size``, the words by the numbers found for them; words
    without one are left out."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, packed, at, i in zip(batch["_keys"], batch["_packed"], batch["_at"], batch["_i"]):
                different, steps, tf = _unpacked(packed.as_buffer())
                place = np.cumsum(steps)
                row = np.repeat(np.arange(len(different)), different)
                number = np.full(int(place.max(initial=0)) + 1, -1, np.int64)
                if at.is_valid:
                    number[at.values.to_numpy()] = i.values.to_numpy()
                number = number[place]
                kept = np.flatnonzero(number >= 0)
                kept = kept[np.lexsort((number[kept], row[kept]))]
                offsets = np.zeros(len(different) + 1, np.int32)
                np.cumsum(np.bincount(row[kept], minlength=len(different)), out=offsets[1:])
                places = pa.ListArray.from_arrays(offsets, pa.array(number[kept], pa.int32()))
                values = pa.ListArray.from_arrays(offsets, pa.array(tf[kept], pa.float64()))
                plain = [pa.array(np.full(len(different), x)) for x in (np.int8(0), np.int32(size))]
                vectors = pa.StructArray.from_arrays(
                    [*plain, places, values], ["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([keys.values, vectors], ["_key", name])
    return rows


def _one(values: pa.Array) -> pa.Array:
    """A list array of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, the low bytes of all first, compressed, behind the length of that."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    out = zlib.compress(planes.tobytes(), 1)
    return len(out).to_bytes(8, "little") + out


def _unpacked(data: pa.Buffer) -> list[np.ndarray]:
    """The arrays of numbers that were packed one behind the other."""
    out, rest = [], memoryview(data)
    while rest:
        end = 8 + int.from_bytes(rest[:8], "little")
        planes = np.frombuffer(zlib.decompress(rest[8:end]), np.uint8).reshape(4, -1)
        out.append(np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64))
        rest = rest[end:]
    return out


class TopicModel:
    """Latent Dirichlet allocation over the commonest long words of a corpus.

    ``keep`` names columns of the corpus to store with its word counts, for :meth:`assigned`.
    """

    def __init__(self, df: DataFrame, text: str, topics: int = 5, vocab: int = 2000,
                 min_df: int = 5, stop: Sequence[str] | None = None, seed: int = 42,
                 rounds: int = 10, keep: Sequence[str] = ()):
        stop = bilingual_stop_words() if stop is None else stop
        self.tokens = words(text, LONG_WORD, stop)
        rows = df.select(*keep, self.tokens.alias("_tokens"))
        self.counter = CountVectorizer(inputCol="_tokens", outputCol="_counts", minDF=min_df,
                                       vocabSize=vocab).fit(rows.select("_tokens"))
        self.counted = cut_lineage(self.counter.transform(rows).drop("_tokens"))
        counted = self.counted.select("_counts").persist()
        try:
            self.lda = LDA(k=topics, seed=seed, maxIter=rounds, featuresCol="_counts",
                           topicDistributionCol="_mix").fit(counted)
        finally:
            counted.unpersist()

    def terms(self, n: int = 10) -> DataFrame:
        """The ``n`` heaviest words per topic: ``topic``, ``rank``, ``term``, ``weight``."""
        names = F.array(*[F.lit(w) for w in self.counter.vocabulary])
        rows = self.lda.describeTopics(n)
        both = F.arrays_zip("termIndices", "termWeights")
        return (rows.select("topic", F.posexplode(both).alias("_i", "_t"))
                .select("topic", (F.col("_i") + 1).alias("rank"),
                        F.get(names, F.col("_t.termIndices")).alias("term"),
                        F.col("_t.termWeights").alias("weight")))

    def assign(self, df: DataFrame, name: str = "topic") -> DataFrame:
        """The dominant topic of every row."""
        return self._dominant(self.counter.transform(df.withColumn("_tokens", self.tokens)), name)

    def assigned(self, name: str = "topic") -> DataFrame:
        """The kept columns of the corpus with their dominant topic, from the stored counts: its texts
        are not read again."""
        return self._dominant(self.counted, name)

    def _dominant(self, counted: DataFrame, name: str) -> DataFrame:
        mix = vector_to_array("_mix")
        return (self.lda.transform(counted)
                .withColumn(name, (F.array_position(mix, F.array_max(mix)) - 1).cast("int"))
                .drop("_tokens", "_counts", "_mix"))
