"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers, distinct ones once are the fit list, and rows X centred on its means are
never multiplied out to a covariance. Each step is one job over packed blocks of rows: X v, then
Xᵀu of the new u, with the products of that u with all earlier ones. A left vector is X times
a short vector of coefficients, so no column as long as the table is stored. Left and right vectors
are orthogonalised fully, twice. Right vectors V and the small bidiagonal B meet X V = U B; the
singular value decomposition of B then gives the components and their deviations.

Steps go on until the wanted components hold to double precision and nothing larger can be missed:
what is left of the trace, after the steps, bounds every eigenvalue outside their span. Where a step
breaks down (equal eigenvalues, low rank), the next right vector is a new one outside that span.

The driver holds a few vectors of the dimension for each step, at most as many steps as dimensions.
Block sums are added in the order of the blocks, so that reruns agree.

Dropped: null vectors, vectors with null, infinite or undefined entries, vectors whose length is not
the most frequent one (of equally frequent ones the longest), empty vectors. Entries beyond 2^52
count as 2^52. Null ids are carried, repeated rows are rows of the result and one of the fit.
Components whose eigenvalue is zero have no whitened values: a table of one distinct vector has
none, nor has an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.sources.staging import Workspace

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
_LARGEST = 1 << 52
_BLOCK_ROWS = 4096
_EPS = np.finfo(float).eps


def integer_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Usable rows of (vec_id, embedding) with their integer vector ``x``."""
    entry = f"isnull(c) or isnan(c) or abs(c) = double('infinity')"
    whole = f"cast(floor(greatest(least({scale}D * c, {_LARGEST}D), -{_LARGEST}D)) as bigint)"
    rows = vectors.selectExpr("vec_id", "transform(embedding, c -> cast(c as double)) as _c")
    rows = rows.filter(f"size(_c) > 0 and not exists(_c, c -> {entry})")
    sizes = rows.groupBy(F.size("_c").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    common = sizes.limit(1).select("d").first()
    rows = rows.filter(F.size("_c") == (common["d"] if common else 0))
    return rows.selectExpr("vec_id", f"transform(_c, c -> {whole} + {shift}L) as x")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("rows", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK_ROWS):
            x = _matrix(batch.column(0).slice(start, _BLOCK_ROWS))
            columns = [[number], [len(x)], [np.ascontiguousarray(x, "<i8").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK)], schema=_BLOCK)
            number += 1


class FitList:
    """Distinct integer vectors in packed blocks, their number and their exact sums."""

    def __init__(self, workspace: Workspace, vectors: DataFrame):
        distinct = vectors.select("x").distinct()
        self.blocks = workspace.stage(distinct.mapInArrow(_pack, "block long, n long, rows binary"), "fit-list")
        parts = self._sums(lambda x: np.array([x.sum(axis=0)]), np.int64)
        self.n = sum(n for n, _ in parts)
        self.sums = [sum(column) for column in zip(*(p[0].tolist() for _, p in parts))]
        self.dims = len(self.sums)

    def _sums(self, of_block, kind) -> list[tuple[int, np.ndarray]]:
        """Rows and small matrix of each task, blocks and tasks in order; the driver adds them."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = []
            for batch in batches:
                for number, n, rows in zip(*(batch.column(i) for i in range(3))):
                    x = np.frombuffer(rows.as_buffer(), "<i8").reshape(n.as_py(), -1)
                    found.append((number.as_py(), n.as_py(), of_block(x)))
            if found:
                found.sort(key=lambda f: f[0])
                total = found[0][2]
                for _, _, part in found[1:]:
                    total = total + part
                n_rows = sum(n for _, n, _ in found)
                columns = [[found[0][0]], [n_rows], [np.ascontiguousarray(total, kind).tobytes()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _BLOCK)], schema=_BLOCK
                )

        parts = self.blocks.mapInArrow(run, "block long, n long, rows binary").collect()
        parts.sort(key=lambda r: r["block"])  # one row for each task
        width = getattr(self, "dims", None)
        matrices = [np.frombuffer(r["rows"], kind) for r in parts]
        return [(r["n"], m.reshape(-1, width or len(m))) for r, m in zip(parts, matrices)]

    def centred_sums(self, of_block) -> np.ndarray:
        """Sum over blocks of a matrix, as wide as the dimensions, made of their centred rows."""
        centre = Centre(self.n, self.sums)
        parts = self._sums(lambda x: of_block(centre.rows(x)), float)
        return np.sum([p for _, p in parts], axis=0)


@dataclass(frozen=True)
class Centre:
    """Subtracts the means without rounding: n x - S in integers, then one division by n."""

    n: int
    sums: list[int]

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n x - S, as 64-bit integers where they hold it and as Python's otherwise."""
        near = [s // self.n for s in self.sums]  # integers close to the means keep products small
        left = [s - self.n * c for s, c in zip(self.sums, near)]
        shifted = x - np.array(near, np.int64)
        most = max(int(np.abs(shifted).max(initial=0)), 1) * self.n + self.n
        if most >= 1 << 62:
            return shifted.astype(object) * self.n - np.array(left, object)
        return shifted * self.n - np.array(left, np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of squares of n x - S for each row, exact."""
        y = self.exact(x)
        most = int(np.abs(y).max(initial=0))
        if most * most * max(y.shape[1], 1) >= 1 << 63:
            y = y.astype(object)
        return (y * y).sum(axis=1).tolist()


@dataclass(frozen=True)
class Whitening:
    """Mean and components of a fit list: eigenvalues falling, unit eigenvectors as columns."""

    centre: Centre
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    steps: int

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ (self.vectors / np.sqrt(self.eigenvalues))


def _away_from(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """The part of v outside a span of unit vectors, twice for rounding."""
    if basis:
        q = np.stack(basis, axis=1)
        for _ in range(2):
            v = v - q @ (q.T @ v)
    return v


def bidiagonalise(fit: FitList, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Eigenvalues of the covariance, falling, their vectors, the trace, and the number of steps."""
    dims, n = fit.dims, fit.n
    random = np.random.default_rng(seed)
    squares = fit.centred_sums(lambda x: (x * x).sum(axis=0)[None])[0]
    total = float(squares.sum())
    largest = np.sqrt(total)
    right: list[np.ndarray] = []  # v: unit, orthogonal
    coefficients: list[np.ndarray] = []  # w with u = X w
    images: list[np.ndarray] = []  # Xᵀu
    b = np.zeros((dims, dims))  # U B = X V: upper bidiagonal, but where a step broke down
    v = _unit(_away_from(random.standard_normal(dims), right))
    while True:
        k = len(right)
        right.append(v)
        w = v.copy()
        if k:  # the coupling of v with the left vectors so far
            b[:k, k] = np.array([image @ v for image in images])
            w = w - np.stack(coefficients, axis=1) @ b[:k, k]
        image, left_over = np.zeros(dims), np.zeros(0)
        for _ in range(2):
            basis = np.stack([w, *coefficients], axis=1)

            def products(x: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
                u = x @ basis  # X w and the left vectors so far
                found = np.zeros((2 + -(-basis.shape[1] // dims), dims))
                found[0] = x.T @ u[:, 0]
                found[1:].ravel()[: basis.shape[1]] = u.T @ u[:, 0]
                return found

            found = fit.centred_sums(products)
            dots = found[1:].ravel()[: k + 1]
            image, norm, left_over = found[0], np.sqrt(max(dots[0], 0.0)), dots[1:]
            if not k or np.abs(left_over).max() <= 4 * _EPS * largest * max(norm, _EPS * largest):
                break
            w = w - np.stack(coefficients, axis=1) @ left_over
            b[:k, k] += left_over
            image = image - np.stack(images, axis=1) @ left_over
            norm = np.sqrt(max(norm * norm - left_over @ left_over, 0.0))
            if np.abs(left_over).max() <= np.sqrt(_EPS) * norm:
                break  # what is left after this correction is beyond rounding
        if norm > dims * _EPS * largest:
            b[k, k] = norm
            coefficients.append(w / norm)
            images.append(image / norm)
            following = _away_from(image / norm - norm * v, right)
        else:  # X v lies in the span of the left vectors
            coefficients.append(np.zeros(dims))
            images.append(np.zeros(dims))
            following = np.zeros(dims)
        steps = k + 1
        small, sigma, vt = np.linalg.svd(b[:steps, :steps])
        residual = np.linalg.norm(following)
        if steps == dims:
            break
        if steps >= min(wanted, dims):
            outside = max(total - float((b[:steps, :steps] ** 2).sum()), 0.0)
            kept = sigma[:wanted]
            settled = residual * np.abs(small[-1, :wanted]).max() <= 8 * _EPS * sigma[0]
            if settled and outside <= max(kept[-1] ** 2, (dims * _EPS) * total):
                break
        if residual <= np.sqrt(dims) * _EPS * largest:
            following = _away_from(random.standard_normal(dims), right)
        v = _unit(_away_from(following, right))
    vectors = np.stack(right, axis=1) @ vt.T
    return sigma**2 / n, vectors, total / n, steps


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v)
    return v / norm if norm else v


def fit(workspace: Workspace, vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows with integer vectors ``x``, or None where nothing varies."""
    fit_list = FitList(workspace, vectors)
    if fit_list.n < 2:
        return None
    values, directions, trace, steps = bidiagonalise(fit_list, components)
    rank = int((values > (fit_list.dims * _EPS) ** 2 * values[0]).sum()) if values[0] > 0 else 0
    kept = min(components, rank, fit_list.n - 1)
    if not kept:
        return None
    centre = Centre(fit_list.n, fit_list.sums)
    values, directions = values[:kept], directions[:, :kept]
    scaled = directions / np.sqrt(values)

    def products(x: np.ndarray) -> np.ndarray:
        y = x @ scaled
        found = np.zeros((-(-kept * kept // x.shape[1]), x.shape[1]))
        found.ravel()[: kept * kept] = (y.T @ y).ravel()
        return found

    covariance = fit_list.centred_sums(products).ravel()[: kept * kept].reshape(kept, kept) / fit_list.n
    error = float(np.abs(covariance - np.eye(kept)).max())
    return Whitening(centre, values, directions, trace, error, steps)


_RESULT = (
    "component int, n long, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


def _whiten(found: Whitening, schema: pa.Schema):
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = len(found.eigenvalues)
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(start, _BLOCK_ROWS)
                x = _matrix(part.column(1))
                rows = np.repeat(np.arange(len(x)), kept)
                columns = [
                    part.column(0).take(pa.array(rows)),
                    np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x)),
                    np.full(len(rows), found.centre.n),
                    pa.array(found.centre.deviations(x), schema.field(3).type).take(pa.array(rows)),
                    found.whitened(x).ravel(),
                    np.tile(found.eigenvalues / found.trace, len(x)),
                    np.full(len(rows), found.identity_error),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return whiten


def whiten(workspace: Workspace, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each usable row of (vec_id, embedding) and component: the whitened value.

    vec_id, component, n, deviation, whitened, explained, identity_error.
    """
    rows = workspace.stage(integer_vectors(vectors), "integer-vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    found = fit(workspace, rows, components)
    names = f"vec_id {kind}, {_RESULT}"
    if found is None:
        return workspace.spark.createDataFrame([], names)
    arrow_id = rows.select("vec_id").limit(0).toArrow().schema.field(0)
    fields = [("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0))]
    fields += [(name, pa.float64()) for name in ("whitened", "explained", "identity_error")]
    return rows.mapInArrow(_whiten(found, pa.schema([arrow_id, *fields])), names)
