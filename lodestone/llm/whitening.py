"""Embedding whitening by shifted Cholesky QR.

Every component c becomes the integer x = floor(scale * c). The fit list is each distinct vector once;
its sums S are exact. The centred fit list A = Q R is orthogonalised in passes: a pass solves Q = A
R^-1 by triangular solves with the factors found so far, sums the Gram matrix of Q over all tasks, and
its Cholesky factor multiplies R. The first pass adds a small shift to the diagonal, which keeps the
factor positive for any condition number; later passes repeat until Q is orthonormal to rounding. The
singular value decomposition of R (small) then gives the components and eigenvalues of the covariance,
without squaring its condition number.

Tasks add matrices of dimension x dimension; the sums go row by row through a shuffle, so that the
driver gets one matrix in each pass, whatever the number of rows. The distinct vectors are written to
the shared folder once and read by each pass.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries take no part;
vectors of each length are a table of their own with its own fit; repeated rows, and null ids, each
give their rows; components without variance (less than the rounding error of the largest one) give no
rows, so a single distinct vector gives none; a deviation beyond a long is null; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

SCALE = 256
COMPONENTS = 4
MAX_PASSES = 8
SMALL = 1e-8
_BLOCK = 4096  # rows that are multiplied at once
_EPS = float(np.finfo(float).eps)


def integer_rows(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``_id, _x``: the usable vectors with every component c as floor(scale * c)."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    numbers = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))
                          .cast("long"))
    return (rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
            .select(F.col(id_column).alias("_id"), numbers.alias("_x")))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(at, _BLOCK)
            yield part, part["_x"].flatten().to_numpy().reshape(-1, width)


def summed_matrix(fit: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray],
                  shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``of(rows)`` over all blocks of rows, a matrix of ``shape``.

    Each task adds its own blocks; the tasks' sums are added row by row in other tasks.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, rows in _blocks(batches, width):
            total = of(rows) if total is None else total + of(rows)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()),
                                              pa.array(total.tolist(), pa.list_(pa.float64()))],
                                             ["_i", "_v"])

    def add(group: pa.Table) -> pa.Table:
        values = group["_v"].combine_chunks().flatten().to_numpy().reshape(len(group), shape[1])
        # In a fixed order, so that the sum does not depend on which task came first.
        column = [math.fsum(c) for c in values.T]
        return pa.table([group["_i"].slice(0, 1), pa.array([column], pa.list_(pa.float64()))],
                        ["_i", "_v"])

    found = (fit.select("_x").mapInArrow(partial, "_i int, _v array<double>")
             .groupBy("_i").applyInArrow(add, "_i int, _v array<double>").collect())
    out = np.zeros(shape)
    for row in found:
        out[row["_i"]] = row["_v"]
    return out


def upper_factor(gram: np.ndarray) -> np.ndarray:
    """R with R^T R = ``gram``; a column that depends on earlier ones keeps a unit pivot.

    Such a column stays as it is left over by the others and is taken up again by the next pass.
    """
    n = len(gram)
    r = np.zeros((n, n))
    for j in range(n):
        row = gram[j, j:] - r[:j, j] @ r[:j, j:]
        if row[0] > 4 * n * _EPS * gram[j, j]:
            r[j, j:] = row / math.sqrt(row[0])
        else:
            r[j, j] = 1.0
    return r


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows @ inverse(r)`` for upper triangular ``r``, by substitution in blocks of columns."""
    out = np.array(rows, float)
    size = 32
    for at in range(0, len(r), size):
        block = slice(at, at + size)
        out[:, block] -= out[:, :at] @ r[:at, block]
        for j in range(at, min(at + size, len(r))):
            out[:, j] = (out[:, j] - out[:, at:j] @ r[at:j, j]) / r[j, j]
    return out


@dataclass
class Whitening:
    """A fit: ``whiten`` needs the exact sums, the components and their eigenvalues."""
    width: int
    n: int
    sums: list[int]
    vectors: np.ndarray      # one column for each component
    values: np.ndarray       # eigenvalues, falling
    trace: float
    passes: int
    identity_error: float = 0.0

    def centred(self, rows: np.ndarray) -> np.ndarray:
        # n x - S in integers where they fit a double: then the mean costs no digits.
        return (rows - np.array([s // self.n for s in self.sums])
                - np.array([(s % self.n) / self.n for s in self.sums]))

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None where a long does not hold them."""
        sums = [s % 2**64 for s in self.sums]
        about = ((self.n * rows.astype(float) - np.array(self.sums, float)) ** 2).sum(axis=1)
        # Below 2^63 the sum is right although single products may wrap around.
        apart = rows * np.int64(self.n) - np.array(sums, np.uint64).view(np.int64)
        found: list[int | None] = (apart * apart).sum(axis=1).tolist()
        unsure = about >= 2**62
        if self.n * max(int(rows.max(initial=0)), -int(rows.min(initial=0))) >= 2**80:
            unsure[:] = True
        for i in np.flatnonzero(unsure):
            exact = sum((self.n * x - s) ** 2 for x, s in zip(rows[i].tolist(), self.sums))
            found[i] = exact if exact < 2**63 else None
        return found

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ self.vectors / np.sqrt(self.values)


def _exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""
    kind = pa.decimal128(38, 0)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = [0] * width, 0
        for _, rows in _blocks(batches, width):
            # Halves of the numbers, so that no sum of a block passes 64 bits.
            high, low = (rows >> 32).sum(axis=0).tolist(), (rows & 0xFFFFFFFF).sum(axis=0).tolist()
            totals = [t + (h << 32) + v for t, h, v in zip(totals, high, low)]
            n += len(rows)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array(map(Decimal, totals), kind),
                 pa.array([n] * width)], ["_i", "_s", "_n"])

    found = (fit.select("_x").mapInArrow(partial, "_i int, _s decimal(38,0), _n long").groupBy("_i")
             .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n")).collect())
    by = {r["_i"]: r for r in found}
    return by[0]["_n"], [int(by[i]["_s"]) for i in range(width)]


def fitted(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of distinct vectors ``_x`` of ``width`` entries (a table that is stored)."""
    n, sums = _exact_sums(fit, width)
    model = Whitening(width, n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, 0)
    factors: list[np.ndarray] = []

    def orthogonalised(rows: np.ndarray) -> np.ndarray:
        out = model.centred(rows)
        for factor in factors:
            out = solved(out, factor)
        return out

    def gram(rows: np.ndarray) -> np.ndarray:
        q = orthogonalised(rows)
        return q.T @ q

    r = np.eye(width)
    for _ in range(MAX_PASSES):
        found = summed_matrix(fit, width, gram, (width, width))
        size = np.diag(found)
        if not factors:
            model.trace = float(size.sum()) / n
            # The shift that the method proves to be enough, for this bound of the largest eigenvalue.
            bound = min(size.sum(), np.abs(found).sum(axis=1).max())
            found = found + np.eye(width) * (
                11 * (n * width + width * (width + 1)) * _EPS / 2 * bound)
        factor = upper_factor(found)
        factors.append(factor)
        r = factor @ r
        model.passes += 1
        alive = size > 0
        off = np.abs(found - np.eye(width))[np.ix_(alive, alive)].max(initial=0.0)
        if len(factors) > 1 and off <= SMALL:  # this factor takes away what is left
            break
    r[size == 0] = 0  # a column of zeros has no share in the product
    _, singular, rows_v = np.linalg.svd(r)
    values = singular * singular / n
    keep = min(components, int((values > values[0] * width * _EPS).sum()) if values[0] > 0 else 0)
    vectors = rows_v[:keep].T
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])
    model.vectors, model.values = vectors * signs, values[:keep]
    if keep:
        model.identity_error = _identity_error(fit, model)
    return model


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance, less the identity."""
    k = len(model.values)
    means = summed_matrix(fit, model.width, lambda x: model.whitened(x).sum(axis=0)[None], (1, k))
    means = means[0] / model.n

    def products(rows: np.ndarray) -> np.ndarray:
        w = model.whitened(rows) - means
        return w.T @ w

    cov = summed_matrix(fit, model.width, products, (k, k)) / model.n
    return float(np.abs(cov - np.eye(k)).max())


def whitened(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
             components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: for each usable row
    and component, its projection on the component in units of its standard deviation.

    ``n`` is the number of distinct vectors, ``deviation`` the exact sum of (n x - S)^2, ``explained``
    the component's share of all variance; components are numbered from 1 by falling variance.
    """
    usable = integer_rows(rows, id_column, vector, scale)
    fit = cut_lineage(usable.select("_x").distinct())
    widths = [r["_w"] for r in fit.groupBy(F.size("_x").alias("_w")).count().orderBy("_w").collect()]
    kind = usable.schema["_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")

    def of_width(width: int) -> DataFrame:
        same = F.size("_x") == width
        model = fitted(fit.filter(same), width, components)
        k = len(model.values)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, x in _blocks(batches, width):
                rows = np.repeat(np.arange(len(x)), k)
                deviations = pa.array(model.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["_id"].take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)),
                                                                pa.int32()),
                     pa.array(np.full(len(rows), model.n)), deviations.take(pa.array(rows)),
                     pa.array(model.whitened(x).ravel()),
                     pa.array(np.tile(model.values / (model.trace or 1.0), len(x))),
                     pa.array(np.full(len(rows), model.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"])

        return usable.filter(same).mapInArrow(project, schema)

    out = rows.sparkSession.createDataFrame([], schema)
    for width in widths:
        out = out.unionByName(of_width(width))
    return out
