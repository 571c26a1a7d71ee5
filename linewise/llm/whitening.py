"""Embedding whitening: the leading principal components of a quantised embedding table.

Method: mixed-precision refinement.  Spark sums the covariance of the distinct
quantised vectors; the driver, which holds that one d x d matrix and nothing
that grows with the rows, takes its eigenvectors in float32 and corrects them
with Ogita-Aishima iterations (matrix products only) in extended precision.
Eigenvalues too close for the iteration to tell apart are a cluster: a small
eigenproblem of the cluster's own basis picks its directions.

Rows and values:

- a vector that is null, empty, or holds a null or a non-finite entry is
  dropped, as is one with an entry whose ``floor(scale * c)`` is no long;
- where vectors differ in length, the most frequent length stays (the longer
  one on a tie) and the others are dropped;
- repeated vectors count once in the fit and are all returned, equal ids too;
  a null id stays null;
- a component without variance (a constant table, fewer distinct vectors than
  dimensions) has ``whitened`` null and is left out of ``identity_error``;
  ``explained`` is 0 where the whole table has no variance;
- ``deviation`` is null where its exact value is no long;
- an empty table gives no rows.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.tables import empty, stored

SCHEMA = ("vec_id {}, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
_WIDTHS = ("i1", "<i2", "<i4", "<i8")
_WIDE = np.longdouble


# ------------------------------------------------------------------ vectors of a batch

def _vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that stay, their long vectors); ``dims`` 0 takes rows of every length one by one."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.diff(np.asarray(column.offsets)).astype(np.int64)
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (lengths == dims)
    rows = np.flatnonzero(valid)
    if not len(rows):
        return rows, np.zeros((0, dims), np.int64)
    flat = column.take(pa.array(rows)).flatten()
    # A null entry becomes NaN here, so one test drops nulls, NaN and infinities.
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) * scale)
    good = (np.abs(values) < 2.0 ** 63).all(axis=1)
    return rows[good], values[good].astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Each vector as bytes, in the narrowest of four widths that holds it: equal vectors, equal bytes."""
    size = np.maximum(x.max(axis=1), ~x.min(axis=1)) if len(x) else np.zeros(0, np.int64)
    width = np.searchsorted(np.array([1 << 7, 1 << 15, 1 << 31]), size, side="right")
    out: list[bytes] = [b""] * len(x)
    for w, kind in enumerate(_WIDTHS):
        for i in np.flatnonzero(width == w):
            out[i] = bytes([w]) + x[i].astype(kind).tobytes()
    return out


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    out = np.empty((len(column), dims), np.int64)
    for i, b in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(b, _WIDTHS[b[0]], dims, 1)
    return out


def _dimensions(vectors: DataFrame) -> int:
    """The most frequent vector length (the longer one on a tie), 0 without vectors."""
    top = (vectors.where("size(v) > 0").groupBy(F.size("v").alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return top["d"] if top else 0


# ------------------------------------------------------------------ sums over the fit list

def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums by dimension; high and low halves are summed apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _unpacked(batch.column(0), dims)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.record_batch([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, n)),
                                   pa.array(high), pa.array(low)], names=["d", "n", "high", "low"])

    exact = "decimal(38,0)"
    rows = (fit.mapInArrow(run, "d int, n long, high long, low long").groupBy("d")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(exact)).alias("high"),
                 F.sum(F.col("low").cast(exact)).alias("low")).orderBy("d").collect())
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _covariance(fit: DataFrame, dims: int, mean: np.ndarray, n: int, basis: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, or of their projections on ``basis``; one matrix a task is shuffled."""
    k = dims if basis is None else basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((k, k)), False
        for batch in batches:
            y = _unpacked(batch.column(0), dims) - mean
            if basis is not None:
                y = y @ basis
            total += y.T @ y
            seen = True
        if seen:
            yield pa.record_batch([pa.array(np.arange(k, dtype=np.int32)), pa.array(list(total))], names=["i", "row"])

    cells = (fit.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
             .where("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((k, k))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / n
    return out


# ------------------------------------------------------------------ eigenvectors

def _groups(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of at least two neighbouring values (ascending) whose steps do not exceed ``gap``."""
    cuts = np.flatnonzero(np.diff(values) > gap) + 1
    return [g for g in np.split(np.arange(len(values)), cuts) if len(g) > 1]


def _correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: (corrected vectors, eigenvalues, gap that it can tell apart)."""
    r = np.eye(len(a), dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    # Symmetric, so that rounding turns close vectors a little but leaves them orthogonal.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    rest = s - np.diag(values)
    # Frobenius norms bound the spectral norms of the published rule from above.
    gap = 2 * (np.sqrt((rest ** 2).sum()) + np.abs(values).max() * np.sqrt((r ** 2).sum()))
    apart = values[None, :] - values[:, None]
    told = np.abs(apart) > gap
    e = np.where(told, (s + values[None, :] * r) / np.where(told, apart, 1), r / 2)
    return x + x @ e, values, float(gap)


def refined_eigenvectors(v: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix.

    Starts from float32 eigenvectors.  Every step corrects all vectors at once;
    those whose eigenvalues the step cannot tell apart get their directions
    from the eigenproblem of the matrix restricted to their span, shifted by
    their mean so that the small differences keep their digits.  Ends when a
    step no longer changes the vectors beyond a double's precision.
    """
    v = np.asarray(v, np.float64)
    size = float(np.abs(v).max()) if v.size else 0.0
    if not size:
        return np.zeros(len(v)), np.eye(len(v))
    a = v.astype(_WIDE) / _WIDE(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_WIDE)
    for _ in range(steps):
        new, values, gap = _correction(a, x)
        order = np.argsort(values)
        new, values = new[:, order], values[order]
        for group in _groups(values, gap):
            span = new[:, group]
            shifted = a @ span - values[group].mean() * span
            turn = span.T @ shifted
            turn = (turn + turn.T) / 2
            scale = np.abs(turn).max()
            if scale:
                new[:, group] = span @ np.linalg.eigh((turn / scale).astype(np.float64))[1].astype(_WIDE)
        change = np.abs(new - x[:, order]).max()
        x = new
        if change < 1e-17:
            break
    x = x / np.sqrt((x ** 2).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], np.maximum(values[order], 0) * size
    # Either sign is an eigenvector: the largest entry is made positive, so that reruns agree.
    x = x * np.where(np.take_along_axis(x, np.abs(x).argmax(axis=0)[None, :], 0) < 0, -1, 1)
    return values.astype(np.float64), x.astype(np.float64)


# ------------------------------------------------------------------ the operator

def _squares(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n*x - S)^2 per row; None where it is no long."""
    most = n * max(int(np.abs(x).max()), 1) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return (((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1)).tolist()
    out = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(t) if t < 1 << 63 else None for t in out]


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
           components: int = 4) -> DataFrame:
    """Whitened coordinates of every vector on the leading ``components`` principal components.

    One row per remaining row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error`` (see the module for the cases).  The
    table is read three times, the stored distinct vectors three times; besides
    those, shuffles carry one d x d matrix a task.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    table = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    dims = _dimensions(table)
    if not dims:
        return empty(spark, SCHEMA.format(kind))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = set(_packed(_vectors(batch.column(0), dims, scale)[1]))
            yield pa.record_batch([pa.array(list(keys), pa.binary())], names=["x"])

    fit = stored(table.select("v").mapInArrow(distinct, "x binary").distinct(), "fit-vectors")
    n, sums = _sums(fit, dims)
    if not n:
        return empty(spark, SCHEMA.format(kind))
    mean = np.array([s / n for s in sums])
    v = _covariance(fit, dims, mean, n)
    values, basis = refined_eigenvectors(v)
    k = min(components, dims)
    trace = float(np.trace(v))
    spread = values[:k] > dims * np.finfo(np.float64).eps * values[0]
    scaled = basis[:, :k] / np.sqrt(np.where(spread, values[:k], 1.0))
    explained = values[:k] / trace if trace else np.zeros(k)
    used = np.flatnonzero(spread)
    error = (float(np.abs(_covariance(fit, dims, mean, n, scaled[:, used]) - np.eye(len(used))).max())
             if len(used) else None)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _vectors(batch.column(1), dims, scale)
            if not len(rows):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
            whitened = (x - mean) @ scaled
            m = len(rows) * k
            yield pa.record_batch([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(m, n)),
                pa.array([d for d in _squares(x, n, sums) for _ in range(k)], pa.int64()),
                pa.array(whitened.ravel(), mask=np.tile(~spread, len(rows))),
                pa.array(np.tile(explained, len(rows))), pa.array([error] * m, pa.float64()),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(project, SCHEMA.format(kind))
