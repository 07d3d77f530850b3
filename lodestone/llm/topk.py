"""Exact top-k by inner product, without random access.

The vectors are dealt into shards. A shard holds one list per component, sorted by value. For each
query the lists are read in sequence from their better end; every vector has a lower and an upper
bound (what was read, plus the worst or the best that its unread components can add). Reading
stops when few vectors can still reach the k-th best lower bound; their scores are then resolved
exactly. The best k of all shards are merged. Queries are dealt into blocks, and each (shard, block)
is a task of its own, so neither side is collected or broadcast.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an
id, take no part; only vectors of a query's own length are its candidates; repeated rows are
candidates of their own, and each repeated query row is answered; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

SCALE = 1024
SHARD = 4096
QUERY_BLOCK = 512
#: Share of each list that has been read after each round.
DEPTHS = (0.5, 0.75, 0.875, 0.94, 0.97, 1.0)


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                    scale: int = SCALE) -> DataFrame:
    """``_row, _id, _v``: the usable vectors with every component x as floor(scale * x)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    numbers = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
                          .cast("long"))
    return (rows.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & finite)
            .select(F.col(id_column).alias("_id"), numbers.alias("_v"))
            .withColumn("_row", F.monotonically_increasing_id()))


class Shard:
    """The sorted lists of some vectors of one length."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(vectors, axis=0).T.copy()

    def top(self, query: np.ndarray, k: int, skip: np.ndarray, ties: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the k best vectors but ``skip``; equal scores by ``ties``."""
        n = len(self.vectors)
        alive = np.ones(n, bool)
        alive[skip] = False
        if not alive.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = np.flatnonzero(query)
        weights = query[lists]
        known = np.zeros(n)
        unread = np.ones((n, len(lists)), np.float32)
        low = np.minimum(weights * self.sorted[lists, 0], weights * self.sorted[lists, -1])
        wanted = min(k, int(alive.sum()))
        done = 0
        for depth in DEPTHS:
            upto = int(np.ceil(n * depth))
            best = np.zeros(len(lists))
            for c, (d, w) in enumerate(zip(lists.tolist(), weights.tolist())):
                part = slice(done, upto) if w < 0 else slice(n - upto, n - done)
                ids = self.order[d, part]
                known[ids] += w * self.sorted[d, part]
                unread[ids, c] = 0
                if upto < n:
                    best[c] = w * self.sorted[d, upto if w < 0 else n - upto - 1]
            done = upto
            # Single precision may be off by a few units of the bounds' size: allow for it.
            slack = 1e-4 * (np.abs(low).sum() + np.abs(best).sum()) + 1e-9 * np.abs(known).max()
            lower = (known + unread @ low.astype(np.float32))[alive]
            floor = np.partition(lower, len(lower) - wanted)[len(lower) - wanted] - slack
            can = alive & (known + unread @ best.astype(np.float32) + slack >= floor)
            if upto == n or can.sum() <= max(4 * k, n // 32):
                break
        rest = np.flatnonzero(can)
        scores = self.vectors[rest] @ query
        first = np.lexsort((ties[rest], -scores))[:k]
        return rest[first], scores[first]


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id",
          vector: str = "embedding", scale: int = SCALE, shard: int = SHARD) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each row marked by ``is_query``,
    a condition on the id."""
    usable = cut_lineage(integer_vectors(rows, id_column, vector, scale))
    queries = (usable.withColumn(id_column, F.col("_id")).filter(is_query)
               .select("_row", "_id", "_v"))
    n, m = usable.count(), queries.count()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-m // QUERY_BLOCK))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    deal = F.pmod(F.xxhash64("_row", F.lit("deal")), F.lit(shards)).cast("int")
    left = usable.withColumn("_shard", deal).withColumn("_block", every(blocks))
    right = (queries.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
             .withColumn("_shard", every(shards)))
    size = F.size("_v").alias("_size")
    kind = usable.schema["_id"].dataType.simpleString()
    names = ["_query", "_qid", "vec_id", "_row", "score"]

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        types = [pa.int64(), queries["_id"].type, queries["_id"].type, pa.int64(), pa.int64()]
        if len(vectors) and len(queries):
            width = len(vectors["_v"][0])
            flat = [t["_v"].combine_chunks().flatten().to_numpy().reshape(len(t), width)
                    for t in (vectors, queries)]
            index = Shard(flat[0])
            ids, numbers = vectors["_id"].to_numpy(), vectors["_row"].to_numpy()
            for row, qid, query in zip(queries["_row"].to_pylist(), queries["_id"].to_pylist(),
                                       flat[1]):
                found, scores = index.top(query, k, np.flatnonzero(numbers == row), ids)
                for column, values in zip(out, (
                        [row] * len(found), [qid] * len(found), ids[found].tolist(),
                        numbers[found].tolist(), scores.tolist())):
                    column.extend(values)
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names)

    keys = ["_size", "_shard", "_block"]
    near = (left.withColumn("_size", size).groupBy(*keys)
            .cogroup(right.withColumn("_size", size).groupBy(*keys))
            .applyInArrow(search, f"_query long, _qid {kind}, vec_id {kind}, _row long, score long"))
    best = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id", "_row")
    return (near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select(F.col("_qid").alias("query_id"), "rank", "vec_id", "score"))
