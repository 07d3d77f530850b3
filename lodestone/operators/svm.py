"""Linear support vector machines of all classes, one against the rest, fitted in the same passes."""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import dealt

_BLOCK = 1 << 18  # entries of a block of rows
_ANSWERS = 64 << 20  # bytes of the gradients that reach the driver in one pass
_MEMORY = 10  # steps a search remembers


def one_against_rest(df: DataFrame, key: str, features: str, label: str, weight: str, classes: int,
                     rounds: int, penalty: float, tolerance: float = 1e-6) -> list[LinearSVCModel]:
    """A :class:`LinearSVC` for each label 0, 1, ... ``classes`` - 1 against all others.

    The loss (weighted hinge, ``penalty`` on the coefficients as they are, features of unit deviation and
    mean 0 inside) and the search (:func:`_search`) are the library's, so its machines come out. The library
    fits one machine after the other, with a job for each step of each search. Here one pass over the
    rows answers the next two steps of every machine. What comes to the driver in a pass is limited: if there
    are more machines than fit, they are fitted some at a time.
    """
    context = df.sparkSession.sparkContext
    rows = dealt(df.select(key, features, label, weight), key).drop(key)
    summary = rows.select(Summarizer.metrics("mean", "std").summary(
        F.col(features), F.col(weight)).alias("s")).select("s.mean", "s.std").first()
    mean, std = summary["mean"].toArray(), summary["std"].toArray()
    inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
    parts = context.defaultParallelism
    blocks = (rows.select(F.unwrap_udt(features).alias("v"), F.col(label).cast("int").alias("y"),
                          F.col(weight).cast("double").alias("w"))
              .coalesce(parts).mapInArrow(_packer(inverse), "x binary, y binary, w binary, at binary, "
                                          "n binary, by binary").rdd.map(tuple)
              .persist(StorageLevel.MEMORY_AND_DISK))
    machines = []
    try:
        at_once = max(1, _ANSWERS // (8 * 3 * parts * (len(mean) + 2)))
        for first in range(0, classes, at_once):
            some = np.arange(first, min(first + at_once, classes))
            machines += _fitted(context, blocks, some, mean * inverse, inverse, rounds, penalty, tolerance)
    finally:
        blocks.unpersist()
    jvm = context._jvm.org.apache.spark.ml.classification
    return [LinearSVCModel(jvm.LinearSVCModel(f"one_against_rest_{k}", _py2java(
        context, Vectors.dense(x[:-1] * inverse)), float(x[-1]))) for k, x in enumerate(machines)]


def _packer(inverse: np.ndarray):
    """Rows into blocks of scaled entries: values, labels, weights, columns, entries of each row, and the
    order of the entries by column."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [_entries(v) for v in batch["v"]]
            lengths = np.array([len(at) for at, _ in plain], np.int32)
            y = batch["y"].to_numpy(zero_copy_only=False).astype(np.int32)
            w = batch["w"].to_numpy(zero_copy_only=False).astype(np.float64)
            group = (np.cumsum(lengths, dtype=np.int64) - lengths) // _BLOCK
            for g in np.unique(group):
                of = np.flatnonzero(group == g)
                at = np.concatenate([plain[i][0] for i in of])
                x = np.concatenate([plain[i][1] for i in of]) * inverse[at]
                by = np.argsort(at, kind="stable").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.tobytes()], pa.binary()) for c in (x, y[of], w[of], at, lengths[of], by)],
                    ["x", "y", "w", "at", "n", "by"])
    return pack


def _entries(v) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of a vector as it is stored, sparse (type 0) or dense."""
    values = v["values"].values.to_numpy(zero_copy_only=False)
    if v["type"].as_py() == 0:
        return v["indices"].values.to_numpy(zero_copy_only=False), values
    at = np.flatnonzero(values).astype(np.int32)
    return at, values[at]


def _sums(places: np.ndarray, n: int, terms: np.ndarray) -> np.ndarray:
    """Sums of the terms by their places, which ascend."""
    out = np.zeros((n, terms.shape[1]))
    if len(places):
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        out[places[starts]] = np.add.reduceat(terms, starts, axis=0)
    return out


def _hinge(blocks, some: np.ndarray, points: np.ndarray, centre: np.ndarray):
    """Losses, gradients (before the centre is taken off), sums of the rows' slopes, and of the weights."""
    size = points.shape[0] - 1
    offset = points[size] - centre @ points[:size]
    loss, slopes, weights = np.zeros(len(some)), np.zeros(len(some)), 0.0
    gradient = np.zeros((size, len(some)))
    for x, y, w, at, n, by in blocks:
        x, w = np.frombuffer(x), np.frombuffer(w)
        y, at, n, by = (np.frombuffer(c, np.int32) for c in (y, at, n, by))
        row = np.repeat(np.arange(len(n), dtype=np.int32), n)
        side = np.where(y[:, None] == some, 1.0, -1.0)
        gap = 1.0 - side * (_sums(row, len(n), points[at] * x[:, None]) + offset)
        inside = gap > 0
        loss += w @ np.where(inside, gap, 0.0)
        slope = np.where(inside, -side, 0.0) * w[:, None]
        gradient += _sums(at[by], size, slope[row[by]] * x[by, None])
        slopes += slope.sum(axis=0)
        weights += w.sum()
    return loss, gradient, slopes, weights


def _fitted(context, blocks, some: np.ndarray, centre: np.ndarray, inverse: np.ndarray, rounds: int,
            penalty: float, tolerance: float) -> list[np.ndarray]:
    """The machines of some classes. All searches go on together: each waits for the values and the
    gradients at some points, and one pass over the blocks finds those of all waiting ones."""
    shrink = penalty * inverse * inverse
    ends: dict[int, np.ndarray] = {}
    searches = {int(k): _search(len(centre) + 1, rounds, tolerance) for k in some}
    asked = {k: next(search) for k, search in searches.items()}
    while asked:
        owners = np.array([k for k, points in asked.items() for _ in points])
        sent = context.broadcast((owners, np.stack(sum(asked.values(), []), axis=1), centre))
        answers = blocks.mapPartitions(lambda part: [_hinge(part, *sent.value)]).collect()
        sent.destroy()
        loss, gradient, slopes, weights = (sum(column) for column in zip(*answers))
        gradient -= np.outer(centre, slopes)
        waiting, asked, i = asked, {}, 0
        for k, points in waiting.items():
            found = []
            for point in points:
                w = point[:-1]
                found.append((loss[i] / weights + 0.5 * float(w @ (shrink * w)),
                              np.append(gradient[:, i] / weights + shrink * w, slopes[i] / weights)))
                i += 1
            try:
                asked[k] = searches[k].send(found)
            except StopIteration as end:
                ends[k] = np.append(end.value[:-1], end.value[-1] - centre @ end.value[:-1])
    return [ends[int(k)] for k in some]


class _Stuck(Exception):
    """A search that cannot go on from its present state."""


def _search(size: int, rounds: int, tolerance: float) -> Generator[list, list, np.ndarray]:
    """A minimum from 0, as the library's OWL-QN without an L1 term finds it: asks for points, is sent value
    and gradient at each, and returns the last one taken."""
    x = np.zeros(size)
    value, grad = (yield [x])[0]
    first, seen = value, deque([np.inf], 20)
    history: deque = deque(maxlen=_MEMORY)
    done, failed = 0, False
    while not (done >= rounds
               or (len(seen) >= 2 and abs(value - max(seen)) <= tolerance * abs(first))
               or np.linalg.norm(grad) <= max(tolerance * value, 1e-8)):
        try:
            new, new_value, new_grad = yield from _step(x, value, grad, _direction(grad, history), done)
        except _Stuck:
            if failed:
                break
            failed = True
            history.clear()
            continue
        history.appendleft((new - x, new_grad - grad))
        x, value, grad, failed = new, new_value, new_grad, False
        seen.append(value)
        done += 1
    return x


def _direction(grad: np.ndarray, history: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction, without the coordinates that it would send uphill."""
    d, scale, parts = grad.copy(), 1.0, []
    if history:
        step, change = history[0]
        curve = step @ change
        if curve < 0 or np.isnan(curve):
            raise _Stuck
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = curve / (change @ change)
    with np.errstate(divide="ignore", invalid="ignore"):
        for step, change in history:
            rho = step @ change
            a = (step @ d) / rho
            if np.isnan(a):
                raise _Stuck
            d -= a * change
            parts.append((a, rho))
        d *= scale
        for (step, change), (a, rho) in zip(reversed(history), reversed(parts)):
            d += (a - (change @ d) / rho) * step
    return np.where(-d * grad < 0, -d, 0.0)


def _step(x: np.ndarray, value: float, grad: np.ndarray, d: np.ndarray, done: int):
    """The library's backtracking: the step is cut until the value falls enough and the slope is small
    enough either way, or lengthened; the first length is never taken. No coordinate crosses 0. With each
    point it asks for both that can come next."""
    known: dict = {}

    def moved(alpha: float) -> np.ndarray:
        new = x + alpha * d
        return np.where(np.sign(new) == orthant, new, 0.0)

    def seen(alpha: float):
        if alpha not in known:
            known.clear()
            next_ones = [alpha, alpha * cut, alpha * 2.1]
            known.update(zip(next_ones, (yield [moved(a) for a in next_ones])))
        return known[alpha]

    orthant = np.where(x != 0, np.sign(x), np.sign(-grad))
    slope = grad @ d
    cut = 0.1 if done < 1 else 0.5
    alpha = 0.5 / np.linalg.norm(grad) if done < 1 else 1.0
    found = None
    now, falls = value, 0.0
    if not value > value + alpha * slope * 1e-4:  # else the first length is cut unseen
        found = yield from seen(alpha)
        falls = found[1] @ d
    for _ in range(19):
        if now > value + alpha * slope * 1e-4:
            factor = cut
        elif falls < 0.9 * slope:
            factor = 2.1
        elif falls > -0.9 * slope:
            factor = cut
        else:
            break
        alpha *= factor
        if not 1e-10 <= alpha <= 1e10:
            raise _Stuck
        found = yield from seen(alpha)
        now, falls = found[0], found[1] @ d
    return moved(alpha), *found
