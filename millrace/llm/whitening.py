"""Whitening of vectors by the leading eigenvectors of their covariance, found by LOBPCG over distributed products.

Entries become whole numbers (64 steps to a unit, shifted), so sums, means and deviations are exact and equal vectors are found
exactly. The covariance is over the distinct vectors and is never formed: a task centres its rows and multiplies them with a block
of directions, and the products are summed by dimension. Each iteration of the locally optimal block preconditioned conjugate
gradient method does a Rayleigh-Ritz step on the span of the iterate, its residuals and the previous directions, with the product of the
whole basis made afresh in one pass. It ends when the residuals certify the wanted components; the driver holds blocks of
(dimensions x directions) alone.

A guard of extra directions speeds convergence. Where three blocks fill the whole space, the step is exact.

Defined results: rows with a null vector or null, infinite or NaN entries are dropped, as are empty vectors; vectors of several
lengths are a ValueError, as are entries beyond 2^40 in size; components without variance (up to rounding) are left out, so
equal vectors alone, or one, give no rows; equal eigenvalues give any orthogonal vectors of their space; rows that share an id
each have results; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

STEPS, SHIFT = 64, 1_000_000
#: Residuals, in units of the largest eigenvalue, that certify a component, and below which they may stop falling.
TOLERANCE = 1e-13
FLOOR = 1e-10
#: Eigenvalues below this share of the largest are rounding.
RANK = 1e-12


def whole(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and their entries as whole numbers, a row each."""
    flat = vectors.flatten()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False), np.int64)
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ends = np.cumsum(lengths)
    kept = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    if not kept.any():
        return kept, np.empty((0, 0), np.int64)
    found = np.unique(lengths[kept])
    if len(found) > 1:
        raise ValueError(f"vectors of {found[0]} and of {found[-1]} entries")
    rows = values[np.repeat(kept, lengths)].reshape(-1, found[0])
    if np.abs(rows).max() > 2.0**40:
        raise ValueError("an entry is beyond 2^40")
    return kept, np.floor(STEPS * rows).astype(np.int64) + SHIFT


def whole_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): kept rows with their whole numbers as little-endian 64-bit integers."""

    def run(batches):
        for batch in batches:
            kept, x = whole(batch.column(1))
            raw = x.astype("<i8").tobytes()
            n = 8 * x.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)), pa.array([raw[i : i + n] for i in range(0, len(raw), n)] if n else [], pa.binary())], ["key", "x"])

    return df.select(F.col(key).alias("key"), F.col(vector).alias("v")).mapInArrow(run, f"key {df.schema[key].dataType.simpleString()}, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), -1)


def _summed(fit: DataFrame, make, width: int) -> np.ndarray:
    """The sum over tasks of a function's matrices, added up by row of the matrix; float64, width columns."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = make(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), *[pa.array(c) for c in np.ascontiguousarray(total.T)]], ["row", *[f"c{j}" for j in range(width)]])

    rows = fit.mapInArrow(run, "row int, " + ", ".join(f"c{j} double" for j in range(width)))
    out = rows.groupBy("row").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)]).orderBy("row").toArrow()  # a row for each dimension
    return np.stack([out.column(f"c{j}").to_numpy() for j in range(width)], axis=1)


@dataclass(frozen=True)
class Whitening:
    """n vectors, their sums by dimension, unit eigenvectors as columns, eigenvalues in falling order, the covariance's trace, the
    largest residual and the largest entry of the whitened covariance less the identity."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float
    iterations: int


def _orthonormal(block: np.ndarray, against: np.ndarray | None = None) -> np.ndarray:
    """An orthonormal basis of what a block adds to `against`."""
    for _ in range(2):
        if against is not None:
            block = block - against @ (against.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 1e-14 * max(1e-300, norms.max(initial=0))]
        if not block.shape[1]:
            return block
        block = block / np.linalg.norm(block, axis=0)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10 * s[0]]
    return block


def lobpcg(multiply, dimensions: int, count: int, guard: int = 8, most: int = 300, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Eigenvalues in falling order, unit eigenvectors, the largest residual over the largest eigenvalue, and the iterations.

    multiply(block) gives the matrix' product with a block of directions. The whole basis is multiplied anew in each iteration,
    so residuals carry no error from earlier ones and certify what they are taken for. Residuals that have stopped falling below
    FLOOR are rounding; if `most` iterations leave more, that is an error."""
    block = min(dimensions, count + guard)
    basis, p, seen = _orthonormal(np.random.default_rng(7).standard_normal((dimensions, block))), None, []
    for i in range(1, most + 1):
        product = multiply(basis)
        small = basis.T @ product
        values, c = np.linalg.eigh((small + small.T) / 2)
        values, c = values[::-1][:block], c[:, ::-1][:, :block]
        x = basis @ c
        residuals = product @ c - x * values
        scale = max(values[0], 1e-300)
        seen.append(float(np.linalg.norm(residuals[:, :count], axis=0).max(initial=0) / scale))
        stuck = len(seen) > 4 and seen[-1] < FLOOR and min(seen[-3:]) > 0.5 * min(seen[:-3])
        if seen[-1] <= tolerance or stuck or basis.shape[1] == dimensions:
            return values[:count], x[:, :count], seen[-1], i
        c[:block] = 0  # the step's part outside the last iterate
        p = basis @ c if i > 1 else None
        x = np.linalg.qr(x)[0]
        live = np.linalg.norm(residuals, axis=0) > 0.1 * tolerance * scale
        basis = np.hstack([x, _orthonormal(residuals[:, live], x)])
        if p is not None:
            basis = np.hstack([basis, _orthonormal(p, basis)])[:, :dimensions]
    raise RuntimeError(f"{most} iterations left a residual of {seen[-1]:.1e}")


def fit_whitening(rows: DataFrame, components: int = 16, guard: int = 8) -> Whitening | None:
    """The components of the distinct vectors among rows (key, x) of whole_rows; None if there is no row."""
    fit = table(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"))
    sizes = fit.agg(F.count("*").alias("n"), F.min(F.octet_length("x")).alias("least"), F.max(F.octet_length("x")).alias("most")).first()
    n = sizes["n"]
    if not n:
        return None
    if sizes["least"] != sizes["most"]:
        raise ValueError(f"vectors of {sizes['least'] // 8} and of {sizes['most'] // 8} entries")
    dimensions = sizes["most"] // 8
    # exact: differences from the shift are summed in two halves of 24 bits, each exact as a double up to 2^29 vectors a task
    halves = _summed(fit, lambda x: np.stack([((x - SHIFT) >> 24).sum(axis=0), ((x - SHIFT) & 0xFFFFFF).sum(axis=0)], axis=1).astype(np.float64), 2)
    sums = [(int(a) << 24) + int(b) + n * SHIFT for a, b in halves.tolist()]
    mean = np.array([s / n for s in sums])

    def multiply(block: np.ndarray) -> np.ndarray:
        b = fit.sparkSession.sparkContext.broadcast(np.ascontiguousarray(block))
        try:
            return _summed(fit, lambda x: (c := x - mean).T @ (c @ b.value), block.shape[1]) / n
        finally:
            b.unpersist()

    trace = float(_summed(fit, lambda x: ((x - mean) ** 2).sum(axis=0)[:, None], 1).sum()) / n
    if trace <= 0:
        return Whitening(n, sums, np.empty((dimensions, 0)), np.empty(0), 0.0, 0.0, 0.0, 0)
    values, vectors, residual, iterations = lobpcg(multiply, dimensions, min(components, dimensions), guard)
    real = values > RANK * values[0]
    values, vectors = values[real], vectors[:, real]
    scaled = vectors / np.sqrt(values)
    gram = _summed(fit, lambda x: (w := (x - mean) @ scaled).T @ w, len(values)) / n
    return Whitening(n, sums, vectors, values, trace, residual, float(np.abs(gram - np.eye(len(values))).max()), iterations)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - sum)^2, exactly; an OverflowError where a long can't hold it."""
    d = x - np.array([s // n for s in sums])  # small, so that products stay small
    rest = np.array([s % n for s in sums])
    most = n * (int(np.abs(d).max(initial=0)) + 1)
    if most**2 * x.shape[1] < 1 << 63:
        return ((n * d - rest) ** 2).sum(axis=1).tolist()
    out = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in d.tolist()]
    if max(out) >= 1 << 63:
        raise OverflowError("a deviation is beyond 64 bits")
    return out


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """key, component (from 1), n, deviation, whitened, explained, identity_error: a row for every kept row and component."""
    rows = whole_rows(df, key, vector)
    model = fit_whitening(rows, components)
    schema = f"key {df.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    mean = np.array([s / model.n for s in model.sums])
    scaled, explained, k = model.vectors / np.sqrt(model.values), model.values / (model.trace or 1.0), len(model.values)

    def run(batches):
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 4000):
                batch = whole_batch.slice(start, 4000)
                x = _matrix(batch.column(1))
                m = len(x)
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), pa.array(np.repeat(np.array(deviations(x, model.n, model.sums), np.int64), k)),
                     pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error))],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
