"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

1. A vector's entries become whole numbers floor(``scale`` * c) + ``shift``.
   The fit list holds each distinct whole vector once: a map-side distinct,
   so a vector that a third of all rows share travels once per task.
2. Its size n and the sums S per dimension are exact: tasks add the numbers in
   two halves, the driver joins one row per dimension in Python integers.
3. A second pass centres every vector, (n * x - S) / n with the numerator in
   exact integers, and adds the outer products; one cell per pair of
   dimensions and task is summed in Spark.  The driver gets the matrix:
   dimensions squared, whatever the number of rows.
4. Pivoted Cholesky of the covariance V gives P'VP = LL' with L lower
   triangular, cut where a pivot falls under the rounding of the first.
   One-sided Jacobi turns pairs of columns of L until all are orthogonal: the
   squared norms of the columns are then the eigenvalues and the normalised
   columns the components.  V is never squared or turned itself, which keeps
   small eigenvalues exact relative to their own size.
5. A third pass over the fit list takes the covariance of the whitened values;
   the last one writes the rows, with the components (``k`` times the
   dimensions) sent along.

Defined cases: rows whose vector is null, or holds a null or non-finite
entry, are dropped, so are rows without a dimension and rows whose number of
dimensions is not that of most distinct vectors (ties: the larger).  Entries
beyond +-2^45 / ``scale`` count as that.  Components of eigenvalue 0 are not
returned: a table of one distinct vector, like an empty one, gives an empty
result.  A deviation beyond 64 bits is null.  Repeated rows and null ids give
rows of their own; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.tables import pick

_HALF = 20      # bits of the low half of a number in the sums
_LIMIT = 1 << 45
_ROWS = 1 << 12     # vectors centred at a time


@dataclass
class Whitening:
    """n and S of the fit list, eigenvalues and components (columns), trace of the covariance."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.whole(x) / self.n).astype(np.float64)

    def whole(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in Python integers where 64 bits could be too few."""
        most = max([abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))])
        if self.n * most + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def whole_vectors(vectors: DataFrame, scale: int, shift: int, id_col: str, vector_col: str) -> DataFrame:
    """doc_id, x (array<long>) of the rows that remain."""
    slim = pick(vectors, vec_id=id_col, v=vector_col).filter(
        "v is not null and size(v) > 0").withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    edge = float(_LIMIT)

    def whole(c):
        return F.floor(F.greatest(F.lit(-edge), F.least(F.lit(edge), c * float(scale)))) + F.lit(shift)

    return slim.filter(finite).select("vec_id", F.transform("v", whole).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part, _matrix(part.column("x"), width)


def _sums(fit_list: DataFrame, width: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for part, x in _slices(batches, width):
            high += (x >> _HALF).sum(axis=0)
            low += (x & ((1 << _HALF) - 1)).sum(axis=0)
            n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(high), pa.array(low),
                                              pa.array(np.full(width, n))], ["j", "high", "low", "n"])

    rows = (fit_list.mapInArrow(run, "j long, high long, low long, n long").groupBy("j")
            .agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).orderBy("j").collect())
    return (rows[0].n if rows else 0), [(r.high << _HALF) + r.low for r in rows]


def _scatter(fit_list: DataFrame, width: int, size: int, values) -> np.ndarray:
    """The sum of outer products of ``values(x)`` (``size`` columns) over the fit list."""
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size)), False
        for _, x in _slices(batches, width):
            v = values(x)
            total += v.T @ v
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(i * size + j), pa.array(total[i, j])], ["cell", "v"])

    rows = fit_list.mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((size, size))
    for r in rows:
        out[divmod(r.cell, size)] = r.v
    return np.triu(out) + np.triu(out, 1).T


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (rows in the order of ``v``) with v = L L': each step takes the largest diagonal entry left."""
    rest, columns, first = np.array(v, dtype=np.float64), [], None
    open_ = np.ones(len(v), dtype=bool)
    while open_.any():
        at = int(np.argmax(np.where(open_, np.diag(rest), -np.inf)))
        pivot = rest[at, at]
        first = pivot if first is None else first
        if pivot <= first * len(v) * np.finfo(float).eps:
            break
        column = np.where(open_, rest[:, at], 0.0) / np.sqrt(pivot)
        columns.append(column)
        rest -= np.outer(column, column)
        open_[at] = False
    return np.array(columns).T.reshape(len(v), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and components of L L', from rotations of the columns of L alone.

    A round turns disjoint pairs of columns at once, all pairs meet in a sweep.
    """
    a = np.array(factor, dtype=np.float64)
    width = a.shape[1]
    seats = list(range(width)) + [-1] * (width % 2)
    for _ in range(sweeps if width > 1 else 0):
        turned = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[half:][::-1]) if p >= 0 and q >= 0]
            p, q = np.array(pairs).T
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(alpha * beta)
            skew = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            turned = max(turned, float(skew.max()))
            turn = skew > 1e-16
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a[:, p], a[:, q] = c * x - s * y, s * x + c * y
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if turned < 1e-15:
            break
    values = (a * a).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > 0]
    return values[order], a[:, order] / np.sqrt(values[order])


def fit(fit_list: DataFrame, width: int, k: int) -> Whitening:
    n, sums = _sums(fit_list, width)
    model = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    if n:
        cov = _scatter(fit_list, width, width, model.centred) / n
        values, vectors = one_sided_jacobi(pivoted_cholesky(cov))
        model.values, model.vectors, model.trace = values[:k], vectors[:, :k], float(np.trace(cov))
    return model


def whiten(vectors: DataFrame, k: int = 16, scale: int = 64, shift: int = 1_000_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: ``k`` rows per remaining row."""
    rows = whole_vectors(vectors, scale, shift, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fit_list = materialize(rows.select("x").distinct(), "whitening-vectors")
    sizes = fit_list.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = sizes["width"] if sizes else 0
    right = F.size("x") == width
    model = fit(fit_list.filter(right), width, k)
    found = len(model.values)
    explained = model.values / model.trace if found else model.values
    error = 0.0
    if found:
        cov = _scatter(fit_list.filter(right), width, found, model.whitened) / model.n
        error = float(np.abs(cov - np.eye(found)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _slices(batches, width):
            whole = model.whole(x)
            if whole.dtype == np.int64 and len(x) and float(np.abs(whole).max()) ** 2 * width < 2.0 ** 62:
                deviation = pa.array((whole * whole).sum(axis=1))
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in whole]
                deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            size = len(x) * found
            at = pa.array(np.repeat(np.arange(len(x)), found))
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(size, model.n)), deviation.take(at), pa.array(model.whitened(x).ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(size, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    return rows.filter(right & F.lit(found > 0)).mapInArrow(run, schema)
