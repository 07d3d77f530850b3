"""Cosine top-k of query vectors against a vector table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.window import top_n_per_group

# Rows per block when both sides are large.
BLOCK_ROWS = 4_096


def similar_top_k(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, vector: str,
                  k: int = 5, digits: int = 4) -> DataFrame:
    """The ``k`` most similar items of every query: ``query``, ``item``, ``score``, ``rank``.

    Both sides are cut into blocks of :data:`BLOCK_ROWS` rows, and each task multiplies one block of
    queries with one block of items and gives back its ``k`` best per query. Memory per task is
    two blocks, however large either side is; with a handful of queries the items are read and
    moved once. Vectors that are null, hold a null, or have another length than the query take
    no part.
    """
    partial = _blocked(queries, items, query_id, item_id, vector, k)
    best = top_n_per_group(partial, ["query"], [F.desc("score"), F.asc("item")], k, rank="rank")
    return best.withColumn("score", F.round("score", digits))


def _schema(queries: DataFrame, items: DataFrame, query_id: str, item_id: str) -> str:
    q = queries.schema[query_id].dataType.simpleString()
    i = items.schema[item_id].dataType.simpleString()
    return f"query {q}, item {i}, score double"


def _blocked(queries, items, query_id, item_id, vector, k, block: int = BLOCK_ROWS) -> DataFrame:
    nq = max(1, -(-queries.count() // block))
    ni = max(1, -(-items.count() // block))

    def numbered(df, key, n_own, n_other, own, other):
        others = F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))
        usable = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull())
        return (df.select(key, vector).filter(usable).withColumn("_d", F.size(vector))
                .withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)))
                .withColumn(other, F.explode(others)))

    left = numbered(queries, query_id, nq, ni, "_q", "_i").groupBy("_d", "_q", "_i")
    right = numbered(items, item_id, ni, nq, "_i", "_q").groupBy("_d", "_q", "_i")

    def score(q: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(i):
            return pd.DataFrame({"query": [], "item": [], "score": []})
        return _best(q[query_id].to_numpy(), _unit(np.stack(q[vector]).astype("float64")),
                     i[item_id].to_numpy(), _unit(np.stack(i[vector]).astype("float64")), k)

    return left.cogroup(right).applyInPandas(score, _schema(queries, items, query_id, item_id))


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def _best(keys, matrix, ids, vectors, k) -> pd.DataFrame:
    """The k best ids per key; ties at the cut go to the smaller id, as in the final ranking."""
    order = np.argsort(ids, kind="stable")
    scores = matrix @ vectors[order].T
    top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return pd.DataFrame({
        "query": np.repeat(keys, top.shape[1]),
        "item": ids[order][top].ravel(),
        "score": np.take_along_axis(scores, top, axis=1).ravel(),
    })
