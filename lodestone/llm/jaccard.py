"""Join of documents on the Jaccard similarity of their word n-grams, with Bayesian pruning.

1. Every text becomes its set of five-word shingles and a MinHash signature. Texts with equal sets
   form a class; from there on only classes are compared.
2. Classes that agree in one of ``BANDS`` bands of ``ROWS`` MinHash values are candidates. Chains of
   candidates are contracted to components, so that each candidate pair meets in one place.
3. Within a component, in blocks, the candidates' further MinHash values are compared step by step;
   a pair is dropped once the posterior probability (uniform prior) that its similarity reaches
   the threshold falls below ``TOLERANCE``. The rest is verified exactly on the sets.

A pair at the threshold is no candidate with probability (1 - t**ROWS)**BANDS, about one in a million
at 0.8; it is pruned with about the same probability. A component larger than a block is dealt into
blocks, and each pair of blocks is a task of its own; only counts and spanning links leave a task.

Defined cases: a text of one to four words is one shingle; a null or empty text has none, links to
nothing and forms a class alone; repeated rows and null ids are documents of their own; an empty
table gives no rows; further columns are ignored, and carried by :func:`deduplicated`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.carry import packed, unpacked
from lodestone.llm.components import components
from lodestone.llm.words import hashed_batch, shingles
from lodestone.session import cut_lineage

WIDTH = 5
THRESHOLD = 0.8
ROWS, BANDS = 4, 26
STEP, STEPS = 16, 4
TOLERANCE = 1e-6
BLOCK = 512
BLOCK_BYTES = 8 << 20
GROUP_BYTES = 8 << 20
_HASHES = ROWS * BANDS + STEP * STEPS
_random = np.random.default_rng(314_159)
_A = _random.integers(0, 2**63, _HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, _HASHES, np.uint64)
_CHUNK = 512


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = hashed_batch(texts)
    ends = np.cumsum(counts)
    return [np.unique(shingles(hashes[e - n:e], min(width, n)) if n else hashes[:0])
            for e, n in zip(ends, counts.tolist())]


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    out = np.full(_HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _CHUNK):
        part = found[at:at + _CHUNK, None] * _A + _B
        out = np.minimum(out, part.min(0))
    return (out >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """Fewest matches after each step with which a pair stays.

    With a uniform prior the posterior of m matches in n is a Beta(m + 1, n - m + 1), and
    Pr(similarity >= t) equals Pr(Binomial(n + 1, t) <= m).
    """
    found = []
    for n in range(STEP, STEP * STEPS + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        found.append(m)
    return tuple(found)


def _bands(signatures: np.ndarray) -> np.ndarray:
    """The bands of each signature as pairs of 64-bit values."""
    return np.ascontiguousarray(signatures[:, :ROWS * BANDS]).view(np.uint64).reshape(
        len(signatures), BANDS, -1)


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets i and j, pair by pair."""
    if len(i) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                         for a, b in zip(i.tolist(), j.tolist())], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, inverse, uses = np.unique(np.concatenate(sets), return_inverse=True,
                                      return_counts=True)
    number = np.cumsum(uses > 1) - 1  # a value that only one set has is in no intersection
    shared = uses[inverse] > 1
    owner, column = owner[shared], number[inverse[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        here = np.zeros((len(sets), width), np.float32)
        here[owner[a:b], column[a:b] - low] = 1
        total += here @ here.T
    return total[i, j].astype(np.int64)


def linked_pairs(sets: list[np.ndarray], signatures: np.ndarray, side: np.ndarray,
                 threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of at least the threshold. With two sides, only pairs across them."""
    bands = _bands(signatures)
    sizes = np.array([len(s) for s in sets])
    two = len(np.unique(side)) > 1
    part = Fraction(threshold).limit_denominator(1000)
    first, second = [], []
    for i in range(len(sets) - 1):
        near = (bands[i + 1:] == bands[i]).all(2).any(1)
        small = np.minimum(sizes[i + 1:], sizes[i]) * part.denominator
        near &= small >= np.maximum(sizes[i + 1:], sizes[i]) * part.numerator
        if two:
            near &= side[i + 1:] != side[i]
        js = np.flatnonzero(near) + i + 1
        first.append(np.full(len(js), i))
        second.append(js)
    i = np.concatenate(first) if first else np.zeros(0, np.int64)
    j = np.concatenate(second) if second else np.zeros(0, np.int64)
    matches = np.zeros(len(i), np.int64)
    for step, least in enumerate(least_matches(threshold)):
        low = ROWS * BANDS + step * STEP
        matches += (signatures[i, low:low + STEP] == signatures[j, low:low + STEP]).sum(1)
        stay = matches >= least
        i, j, matches = i[stay], j[stay], matches[stay]
    both = _common(sets, i, j) if len(i) else np.zeros(0, np.int64)
    right = both * part.denominator >= (sizes[i] + sizes[j] - both) * part.numerator
    return i[right], j[right]


def described(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, _text`` (hash), ``_bytes``, ``_set`` (digest of the shingle set, null if empty), ``_sig``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes | None] = []
            signatures: list[bytes | None] = []
            texts = batch["text"]
            for at in range(0, len(texts), 200):
                for found in shingle_sets(texts[at:at + 200].to_pylist(), width):
                    digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                                   if len(found) else None)
                    signatures.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["_text"], batch["_bytes"], pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())], ["doc_id", "_text", "_bytes", "_set", "_sig"])

    return docs.select(
        "doc_id", F.xxhash64("text").alias("_text"),
        F.octet_length("text").cast("long").alias("_bytes"), "text").mapInArrow(
        describe, f"doc_id {kind}, _text long, _bytes long, _set binary, _sig binary")


def _candidates(classes: DataFrame) -> DataFrame:
    """``a, b``: each class with the smallest one of every band it shares."""
    size = 4 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("_sig", k * size + 1, size))
                     for k in range(BANDS)])
    members = classes.select("_class", F.explode(keys).alias("_band"))
    least = (members.groupBy("_band")
             .agg(F.min("_class").alias("b"), F.max("_class").alias("_most"))
             .filter("b < _most").drop("_most"))
    return (members.join(least, "_band").filter("_class <> b")
            .select(F.col("_class").alias("a"), "b").distinct())


class Join:
    """The join's results.

    ``documents``: ``doc_id, _text, _class`` for each row; ``classes``: ``_class, _doc, _copies`` (the
    least id, the number of rows), ``_linked`` (rows in linked classes) and ``_root`` (the least
    class that links lead to).
    """

    def __init__(self, docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH):
        self.docs, self.threshold, self.width = docs, threshold, width
        rows = cut_lineage(described(docs, width)
                           .withColumn("_row", F.monotonically_increasing_id()))
        with_set = rows.filter(F.col("_set").isNotNull())
        classes = cut_lineage(
            with_set.groupBy("_set").agg(
                F.min(F.struct("doc_id", "_text")).alias("_rep"), F.min("doc_id").alias("_doc"),
                F.count(F.lit(1)).alias("_copies"), F.first("_sig").alias("_sig"),
                F.max("_bytes").alias("_bytes"))
            .withColumn("_class", F.monotonically_increasing_id()))
        groups = components(_candidates(classes))
        links = cut_lineage(self._links(classes, groups))
        linked = links.groupBy("_class").agg(F.sum("_docs").alias("_linked"))
        roots = components(links.select("_class", "_near")).select(
            F.col("node").alias("_class"), F.col("root").alias("_root"))
        self.classes = cut_lineage(
            classes.select("_set", "_class", "_doc", "_copies")
            .join(linked, "_class", "left").join(roots, "_class", "left")
            .withColumns({"_linked": F.coalesce("_linked", F.lit(0)),
                          "_root": F.coalesce("_root", "_class")}))
        self.documents = rows.drop("_sig").join(self.classes, "_set", "left").drop("_set")

    def _links(self, classes: DataFrame, groups: DataFrame) -> DataFrame:
        """``_class, _docs, _near``: rows in classes linked within one task, and a spanning link."""
        members = (classes.select("_class", "_copies", "_rep", "_bytes")
                   .join(groups.select(F.col("node").alias("_class"), "root"), "_class"))
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("_bytes") / BLOCK_BYTES))
        sizes = members.groupBy("root").agg(blocks.cast("int").alias("_blocks"))
        members = members.join(sizes, "root").select(
            "_class", "_copies", "root", "_blocks",
            F.col("_rep.doc_id").alias("_id"), F.col("_rep._text").alias("_t"))
        # Equal rows of one representative are one text.
        texts = (self.docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
                 .join(members, F.col("doc_id").eqNullSafe(F.col("_id"))
                       & (F.col("_text") == F.col("_t")))
                 .dropDuplicates(["_class"]).select("_class", "_copies", "root", "_blocks", "text"))
        texts = cut_lineage(texts)
        total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        packs = max(1, -(-total // GROUP_BYTES))
        own = F.pmod(F.xxhash64("_class"), F.col("_blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
        dealt = (texts.withColumn("_own", own).withColumn("_other", other)
                 .withColumn("_task", F.when(F.col("_blocks") == 1, F.pmod(
                     F.xxhash64("root", F.lit("pack")), F.lit(packs))).otherwise(F.xxhash64(
                         "root", F.least("_own", "_other"), F.greatest("_own", "_other"))))
                 .withColumn("_low", F.least("_own", "_other"))
                 .withColumn("_high", F.greatest("_own", "_other"))
                 .select("_task", "root", "_low", "_high", "_own", "_class", "_copies", "text"))
        threshold, width = self.threshold, self.width

        def verify(table: pa.Table) -> pa.Table:
            keys = [table[c].to_numpy() for c in ("root", "_low", "_high")]
            order = np.lexsort(keys[::-1])
            same = np.ones(len(order), bool)
            for key in keys:
                same[1:] &= key[order][1:] == key[order][:-1]
            same[:1] = False
            out: list[tuple[int, int, int]] = []
            for at in np.split(order, np.flatnonzero(~same)[1:]):
                part = table.take(pa.array(at))
                ids, copies = part["_class"].to_numpy(), part["_copies"].to_numpy()
                sets = shingle_sets(part["text"].to_pylist(), width)
                i, j = linked_pairs(sets, np.array([signature(s) for s in sets]),
                                    part["_own"].to_numpy(), threshold)
                docs = (np.bincount(i, copies[j], len(ids))
                        + np.bincount(j, copies[i], len(ids))).astype(np.int64)
                near = _least_reached(ids, i, j)
                for k in np.flatnonzero(docs):
                    out.append((int(ids[k]), int(docs[k]), int(near[k])))
            columns = list(zip(*out)) if out else ([], [], [])
            return pa.table([pa.array(c, pa.int64()) for c in columns],
                            ["_class", "_docs", "_near"])

        return dealt.groupBy("_task").applyInArrow(
            verify, "_class long, _docs long, _near long")


def _least_reached(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id that links lead to, within one task."""
    least = ids.copy()
    while True:
        before = least.copy()
        np.minimum.at(least, i, least[j])
        np.minimum.at(least, j, least[i])
        if (before == least).all():
            return least


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """One row per document.

    ``class_id``: the least id of the documents that links lead to; ``copy_of``: the least id with
    the same shingle set; ``n_links``: other documents of at least the threshold.
    """
    join = Join(docs, threshold, width)
    roots = join.classes.groupBy("_root").agg(F.min("_doc").alias("_least"))
    own: Column = F.col("doc_id")
    return (join.documents.join(roots, "_root", "left")
            .select("doc_id", F.coalesce("_least", own).alias("class_id"),
                    F.coalesce("_doc", own).alias("copy_of"),
                    F.coalesce(F.col("_copies") - 1 + F.col("_linked"), F.lit(0))
                    .cast("long").alias("n_links")))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """The documents without all but one (the least id) of each group that links connect."""
    columns, docs = docs.columns, packed(docs)
    join = Join(docs, threshold, width)
    known = join.documents.select("doc_id", "_text", "_row", "_root")
    first = (known.filter("_root IS NOT NULL").groupBy("_root")
             .agg(F.min(F.struct("doc_id", "_text", "_row")).alias("_kept")).select("_kept.*"))
    kept = first.union(known.filter("_root IS NULL").select(first.columns)).select(
        F.col("doc_id").alias("_id"), F.col("_text").alias("_t"))
    # Equal rows are numbered on both sides, so that as many stay as were kept.
    kept = kept.groupBy("_id", "_t").agg(F.count(F.lit(1)).alias("_n"))
    alike = Window.partitionBy("doc_id", "_text").orderBy("_text")
    return (docs.withColumn("_text", F.xxhash64("text"))
            .withColumn("_nth", F.row_number().over(alike))
            .join(kept, F.col("doc_id").eqNullSafe(F.col("_id"))
                  & (F.col("_text") == F.col("_t")) & (F.col("_nth") <= F.col("_n")))
            .transform(unpacked, columns))
