"""Exact cosine top-k that skips most of the vectors: an index of balls on the sphere.

Every vector belongs to the nearest of some centres, and a ball is as wide as its farthest member. By
the triangle inequality on angles no member is closer to a query than the centre's angle less that
radius. A query first visits the balls around it until they hold k vectors; the k-th best score found
there rules most other balls out, and the rest is visited in a second round. What is skipped could not
have qualified, so the result is that of the full product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.window import top_n_per_group
from lodestone.session import cut_lineage

#: Rows of one side that a task multiplies at once.
BLOCK_ROWS = 4_096
#: Angles are rounded; balls this much too far are visited all the same.
SLACK = 1e-6


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors; a vector of zeros stays as it is."""
    m = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(float)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


class BallIndex:
    """The vectors of length ``width`` (that of the first usable one) of ``items``, in balls.

    The centres are ``balls`` vectors drawn by a hash of their ids; they and the balls' radii and
    sizes are all that the driver holds. Null vectors and those with nulls take no part. Vectors of
    zeros have no angle and form a ball of their own that every query visits.
    """

    def __init__(self, items: DataFrame, item_id: str, vector: str, balls: int = 256,
                 width: int | None = None):
        usable = items.select(F.col(item_id).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
        usable = usable.filter(F.col("_v").isNotNull() & (F.size("_v") > 0)
                               & F.forall("_v", lambda x: x.isNotNull()))
        first = usable.select(F.size("_v")).first() if width is None else None
        self.width = width if width is not None else first[0] if first else 1
        usable = usable.filter(F.size("_v") == self.width)
        self.kind = items.schema[item_id].dataType.simpleString()
        drawn = usable.filter(F.exists("_v", lambda x: x != 0)).orderBy(
            F.xxhash64("_id"), "_id").limit(balls).select("_v").collect()
        self.centres = _matrix(pa.array([r["_v"] for r in drawn], pa.list_(pa.float64())), self.width)
        self.radius, self.size = np.full(balls + 1, -np.inf), np.zeros(balls + 1, np.int64)
        self.rows = cut_lineage(usable.mapInArrow(
            self._placed, f"_ball int, _far double, _id {self.kind}, _v array<double>"))
        found = self.rows.groupBy("_ball").agg(F.max("_far").alias("r"), F.count(F.lit(1)).alias("n"))
        for row in found.collect():
            self.radius[row["_ball"]], self.size[row["_ball"]] = row["r"], row["n"]
        self.examined = self.pairs = 0

    def _placed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch["_v"], self.width)
            ball = np.full(len(m), len(self.radius) - 1)
            far = np.full(len(m), np.pi)
            live = np.flatnonzero(m.any(axis=1))
            if len(live):
                angles = _angles(m[live], self.centres)
                ball[live] = angles.argmin(axis=1)
                far[live] = angles.min(axis=1)
            flat = pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * self.width, m.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(ball, pa.int32()), pa.array(far), batch["_id"],
                                              flat], ["_ball", "_far", "_id", "_v"])

    def _visits(self, queries: DataFrame, kind: str, k: int, second: bool) -> DataFrame:
        """``_q, _v, _ball``: the balls that a query visits in the first or in the second round (in
        which ``queries`` hold the k-th best score so far as ``_floor``)."""
        radius, size, centres, width = self.radius, self.size, self.centres, self.width

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            live = np.flatnonzero(size)
            real = live[live < len(centres)]
            for batch in batches:
                m = _matrix(batch["_v"], width)
                least = np.full((len(m), len(size)), -1.0)
                least[:, real] = np.maximum(_angles(m, centres[real]) - radius[real], 0.0)
                least[~m.any(axis=1)] = -1.0  # a query of zeros is at no angle to anything
                nearest = np.argsort(least[:, live], axis=1, kind="stable")
                before = np.cumsum(size[live][nearest], axis=1) - size[live][nearest]
                near = np.zeros((len(m), len(live)), bool)
                np.put_along_axis(near, nearest, before < k, axis=1)
                wanted = near
                if second:
                    floor = batch["_floor"].to_numpy(zero_copy_only=False)
                    reach = np.arccos(np.clip(np.nan_to_num(floor, nan=-1.0), -1.0, 1.0)) + SLACK
                    wanted = (least[:, live] <= reach[:, None]) & ~near
                row, ball = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays(
                    [batch["_q"].take(pa.array(row)), batch["_v"].take(pa.array(row)),
                     pa.array(live[ball], pa.int32())], ["_q", "_v", "_ball"])

        return queries.mapInArrow(choose, f"_q {kind}, _v array<double>, _ball int")

    def _scored(self, visits: DataFrame, kind: str, k: int) -> DataFrame:
        """``query, item, score``: the best k of each visited part of a ball."""
        visits = cut_lineage(visits)
        asked = np.zeros(len(self.size), np.int64)
        for row in visits.groupBy("_ball").count().collect():
            asked[row["_ball"]] = row["count"]
        self.examined += int((asked * self.size).sum())
        pieces = [[int(max(1, -(-n // BLOCK_ROWS))) for n in side] for side in (asked, self.size)]
        shares = F.array(*[F.struct(F.lit(a).alias("q"), F.lit(b).alias("i")) for a, b in zip(*pieces)])
        share = F.get(shares, F.col("_ball"))

        def dealt(df: DataFrame, own: str, other: str, a: str, b: str, key: str) -> DataFrame:
            return (df.withColumn("_s", share)
                    .withColumn(own, F.pmod(F.xxhash64(key), F.col(f"_s.{a}")).cast("int"))
                    .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"_s.{b}") - 1)))
                    .drop("_s").groupBy("_ball", "_pq", "_pi"))

        wanted = self.rows.drop("_far").filter(
            F.get(F.array(*[F.lit(bool(n)) for n in asked]), F.col("_ball")))
        width = self.width

        def multiply(queries: pa.Table, items: pa.Table) -> pa.Table:
            out = ([], [], [])
            if len(queries) and len(items):
                items = items.sort_by("_id")
                q, m = (_matrix(t["_v"].combine_chunks(), width) for t in (queries, items))
                scores = q @ m.T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                row = np.repeat(np.arange(len(q)), top.shape[1])
                out = (queries["_q"].take(pa.array(row)), items["_id"].take(pa.array(top.ravel())),
                       np.take_along_axis(scores, top, axis=1).ravel())
            return pa.table([pa.array(out[0], queries["_q"].type) if not len(out[0]) else out[0],
                             pa.array(out[1], items["_id"].type) if not len(out[1]) else out[1],
                             pa.array(out[2], pa.float64())], ["query", "item", "score"])

        return dealt(visits, "_pq", "_pi", "q", "i", "_q").cogroup(
            dealt(wanted, "_pi", "_pq", "i", "q", "_id")).applyInArrow(
                multiply, f"query {kind}, item {self.kind}, score double")

    def top_k(self, queries: DataFrame, query_id: str, vector: str, k: int = 5,
              digits: int = 4) -> DataFrame:
        """``query, item, score, rank``: the ``k`` most similar items of every query, ties to the
        smaller item. Afterwards ``examined`` of ``pairs`` pairs have been multiplied."""
        kind = queries.schema[query_id].dataType.simpleString()
        rows = queries.select(F.col(query_id).alias("_q"), F.col(vector).cast("array<double>").alias("_v"))
        rows = cut_lineage(rows.filter((F.size("_v") == self.width) & F.forall("_v", lambda x: x.isNotNull())))
        self.examined, self.pairs = 0, rows.count() * int(self.size.sum())
        first = cut_lineage(self._scored(self._visits(rows, kind, k, False), kind, k))
        best = top_n_per_group(first, ["query"], [F.desc("score"), F.asc("item")], k, rank="rank")
        floors = best.groupBy("query").agg(F.min(F.when(F.col("rank") == k, F.col("score"))).alias("_floor"))
        again = rows.join(floors.withColumnRenamed("query", "_q"), "_q", "left")
        found = first.unionByName(self._scored(self._visits(again, kind, k, True), kind, k))
        best = top_n_per_group(found, ["query"], [F.desc("score"), F.asc("item")], k, rank="rank")
        return best.withColumn("score", F.round("score", digits))


def ball_top_k(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, vector: str,
               k: int = 5, digits: int = 4, balls: int = 256) -> DataFrame:
    """:func:`lodestone.operators.similarity.similar_top_k` by a :class:`BallIndex` of the items."""
    return BallIndex(items, item_id, vector, balls).top_k(queries, query_id, vector, k, digits)
