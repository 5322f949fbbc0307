"""Whitening of embeddings: projection on the covariance's leading eigenvectors, each scaled to variance one.

1. One pass over the table gives count, sums and the dimension; a second one the covariance of the centred vectors. A task
   sends one row of each matrix row; they are added per row by a shuffle, and the driver gets a matrix of fixed size.
2. Eigenvectors come from the covariance in float32. Ogita and Aishima's iteration corrects them by matrix products in
   extended precision. Where eigenvalues are too close for a division by their difference, the cluster's own small
   eigenproblem, shifted by its mean, is solved again in float32, and the iteration goes on.
3. A third pass projects the vectors and measures the covariance of what comes out; a fourth one returns it.

Vectors that are NULL, hold NULL, NaN or infinite entries, or are shorter than the longest vector (as if their last entries
were NULL), or whose entries don't fit the integer grid, are left out. Repeated rows count as often as they come. Directions without variance
(1e-12 of the trace or less) can't be whitened and give no rows; so does an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import python_ready, written

#: The integer grid: x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this are left out: up to here floats hold whole numbers exactly.
LIMIT = 2.0**51
#: Vectors handled at once.
ROWS = 2048
#: Share of the trace under which a direction counts as without variance.
FLAT = 1e-12
#: Corrections at most; each about squares the error.
STEPS = 12
#: Eigenvalues within so many roundings of each other are one, of which any basis is right.
ONE = 1000


def grid(vectors: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the array, x as int64 matrix) of the vectors that can be used, by length; of one length if it is given."""
    valid = np.asarray(vectors.is_valid())
    lengths = np.zeros(len(vectors), np.int64)
    lengths[valid] = np.asarray(vectors.drop_null().value_lengths(), np.int64)
    for n in np.unique(lengths[valid]).tolist() if size is None else [size]:
        where = np.flatnonzero(valid & (lengths == n))
        if n == 0 or not len(where):
            continue
        values = vectors.take(pa.array(where)).flatten()
        full = np.asarray(values.is_valid()).reshape(-1, n).all(axis=1)
        c = values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, n)
        full &= (np.abs(c) < LIMIT / SCALE).all(axis=1)
        yield where[full], np.floor(SCALE * c[full]).astype(np.int64) + SHIFT


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS):
        yield batch.slice(start, ROWS)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    for batch in batches:
        for part in _slices(batch):
            for where, x in grid(part.column(0)):
                n = x.shape[1]
                total[n] = total.get(n, 0) + x.sum(axis=0).astype(object)
                count[n] = count.get(n, 0) + len(where)
    for n, sums in total.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, n, np.int64)),
                pa.array(np.arange(n)),
                pa.array(np.full(n, count[n], np.int64)),
                pa.array(sums.tolist(), pa.decimal128(38, 0)),
            ],
            ["length", "dim", "n", "total"],
        )


@dataclass
class Fit:
    """What all vectors have in common: count, sums per dimension, covariance, its leading eigenpairs."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part of the mean is taken off as integers, so nothing is lost."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - S)^2, exact: as 64-bit integers where they fit, else as Python's."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        off = x - whole
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if most * most * len(self.sums) < 2**63:
            return pa.array(((self.n * off - rest) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = ((self.n * off.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return pa.array(exact.tolist(), pa.decimal128(38, 0))


def _products(shared, size: int, whiten: bool):
    """Per task, rows (dim, count, blob): the sums of the products of all (centred, or whitened) vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, total, count = shared.value, None, 0
        for batch in batches:
            for part in _slices(batch):
                for where, x in grid(part.column(0), size):
                    y = fit.whitened(x) if whiten else fit.centred(x)
                    total = (0 if total is None else total) + y.T @ y
                    count += len(where)
        if count:
            # one matrix row a batch: merging tasks never hold many of them
            for i, row in enumerate(total):
                arrays = [pa.array([i]), pa.array([row.astype("<f8").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["dim", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            row = np.frombuffer(blob.as_buffer(), "<f8")
            total[i] = total[i] + row if i in total else row.copy()
    for i, row in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([row.tobytes()], pa.binary())], ["dim", "sums"])


def _covariance(vectors: DataFrame, fit: Fit, size: int, whiten: bool) -> np.ndarray:
    shared = vectors.sparkSession.sparkContext.broadcast(fit)
    parts = vectors.mapInArrow(_products(shared, size, whiten), "dim long, sums binary")
    rows = parts.repartition("dim").mapInArrow(_added, "dim long, sums binary").collect()
    return np.stack([np.frombuffer(r.sums, "<f8") for r in sorted(rows)]) / fit.n


def _clusters(values: np.ndarray, near: float) -> list[tuple[int, int]]:
    """Runs (start, end) of sorted values with neighbours no more than `near` apart."""
    cuts = np.flatnonzero(np.abs(np.diff(values)) > near) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _corrected(a: np.ndarray, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One correction: eigenvalues, better vectors, how near eigenvalues must be to count as one, and size of the change."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diagonal(s) / (1 - np.diagonal(r))
    off = s - np.diag(values)
    near = 2 * float(np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    near = max(near, ONE * least)
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return values, x + x @ e, near, float(np.abs(e).max())


def _solved_apart(a: np.ndarray, x: np.ndarray, values: np.ndarray, near: float, least: float) -> np.ndarray:
    """Vectors with every cluster turned to the eigenvectors of its own small matrix. Relative to its own width a cluster
    is none, so float32 does; narrower ones than rounding are one eigenvalue, for which any basis is right."""
    for start, end in _clusters(values, near):
        if end - start > 1:
            part = x[:, start:end]
            small = part.T @ (a @ part) - values[start:end].mean() * (part.T @ part)
            width = np.abs(small).max()
            if width > ONE * least:
                turn = np.linalg.eigh(((small + small.T) / (2 * width)).astype(np.float32))[1]
                x[:, start:end] = part @ turn.astype(a.dtype)
    return x


def eigenpairs(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    a = np.asarray(covariance, np.longdouble)
    a = (a + a.T) / 2
    scale = np.abs(a).max() or np.longdouble(1)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    least = float(np.finfo(np.longdouble).eps) * len(a)
    before = np.inf
    for _ in range(STEPS):
        values, x, near, change = _corrected(a, x, least)
        if change <= max(4 * least, 2.0**-52) or before / 2 <= change < 2.0**-40:
            break
        order = np.argsort(values)
        x, before = _solved_apart(a, x[:, order], values[order], near, least), change
    for _ in range(2):
        x = x + x @ ((np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2)
    values = np.diagonal(x.T @ (a @ x)) / np.diagonal(x.T @ x)
    order = np.argsort(-values)
    x = (x / np.sqrt((x * x).sum(axis=0)))[:, order].astype(np.float64)
    return (values[order] * scale).astype(np.float64), x


def fitted(vectors: DataFrame, components: int) -> Fit | None:
    """Fit of a one-column table of vectors; None if there is no vector."""
    sums = vectors.mapInArrow(_sums, "length long, dim long, n long, total decimal(38,0)")
    sums = written(sums.groupBy("length", "dim").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")), "whitening-sums")
    size = sums.agg(F.max("length")).first()[0]
    if size is None:
        return None
    rows = sums.filter(F.col("length") == size).orderBy("dim").collect()
    fit = Fit(rows[0].n, [int(r.total) for r in rows], np.zeros((0, 0)), np.zeros(0), np.zeros((size, 0)), 0.0)
    fit.covariance = _covariance(vectors, fit, size, False)
    fit.trace = float(np.trace(fit.covariance))
    values, x = eigenpairs(fit.covariance)
    used = min(components, int((values > FLAT * fit.trace).sum()))
    fit.values, fit.vectors = values[:used], x[:, :used]
    return fit


def _rows(shared, size: int, error: float, key: pa.DataType):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        k = len(fit.values)
        share = fit.values / fit.trace
        for batch in batches:
            for part in _slices(batch):
                for where, x in grid(part.column(1), size):
                    each = pa.array(np.repeat(np.arange(len(where)), k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(where)).take(each).cast(key),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(where))),
                            pa.array(np.full(len(each), fit.n, np.int64)),
                            fit.deviation(x).take(each),
                            pa.array(fit.whitened(x).reshape(-1)),
                            pa.array(np.tile(share, len(where))),
                            pa.array(np.full(len(each), error)),
                        ],
                        names,
                    )

    return run


def whitened(embeddings: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector and component: vec_id, component (from 1, by falling variance), n, deviation (decimal: the sum over
    dimensions of (n * x - S)^2), whitened, explained (share of the trace), identity_error (largest absolute entry of the
    measured covariance of `whitened` minus the identity)."""
    spark = embeddings.sparkSession
    python_ready(spark)
    vectors = embeddings.select(F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    fit = fitted(vectors, components)
    if fit is None or not len(fit.values):
        schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return spark.createDataFrame([], schema)
    size = len(fit.sums)
    error = float(np.abs(_covariance(vectors, fit, size, True) - np.eye(len(fit.values))).max())
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(_rows(spark.sparkContext.broadcast(fit), size, error, pa.int64()), schema)


def embedding_whitening(embeddings: DataFrame) -> DataFrame:
    """`whitened` with 32 components and the deviation as a long; one that doesn't fit is an error."""
    return whitened(embeddings).withColumn("deviation", F.col("deviation").cast("long"))
