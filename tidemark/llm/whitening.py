"""Embedding whitening by FEAST contour integration.

Rows are whole numbers ``x = floor(1024 c) + 100000``. Three passes of the
cluster give what the model needs: counts and sums, then the covariance around
the mean, then the covariance of the whitened rows. Tasks add up products of
their own rows and Spark sums them cell by cell, so the driver gets
``d (d + 1) / 2`` numbers whatever the number of rows. Products are taken around
the whole number next to the mean, so their sums are whole numbers, exact up to
2^53 and the same in any order; the fraction of the mean left is taken out
afterwards.

The eigenpairs of that matrix come from the FEAST method (Polizzi 2009). Inertia
counts (negative pivots of the shifted matrix, after reduction to tridiagonal
form) cut the top of the spectrum into intervals at its wide gaps. For each
interval a Gauss rule on a circle around it sums solutions of complex shifted
systems ``(z V - ..) X = Y``, which projects a random block onto the interval's
eigenvectors; Rayleigh-Ritz on the projected block extracts them, and the step is
repeated until residuals are at rounding level. As many pairs as the interval's
inertia count must settle, so none is missed; other values inside, of mixtures
that have not settled, are no eigenvalues.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

COMPONENTS = 8
SLICE = 4                 # eigenvalues wanted in an interval
NODES = 16                # quadrature nodes on the upper half circle
ROUNDS = 20               # most repetitions of an interval's projection
SCALE, SHIFT = 1024, 100_000
BATCH_ROWS = 4096


# --- eigenvalues of a symmetric matrix by contour integration

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the Householder reduction of a symmetric matrix."""
    a = np.array(matrix, float)
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        norm = np.linalg.norm(v)
        if norm:
            v /= norm
            rest = a[k + 1:, k:]
            rest -= 2 * np.outer(v, v @ rest)
            rest = a[k:, k + 1:]
            rest -= 2 * np.outer(rest @ v, v)
    return a.diagonal().copy(), a.diagonal(-1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: the negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    below = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], off, strict=True):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - shifts - e * e / pivot
        below += pivot < 0
    return below


@dataclass
class Interval:
    low: float
    high: float
    count: int


def intervals(diagonal: np.ndarray, off: np.ndarray, wanted: int, least: float, slice_size: int = SLICE) -> list[Interval]:
    """Intervals that hold at least the ``wanted`` largest eigenvalues above ``least``, from the top.

    Bisection by inertia places the eigenvalues. An interval takes up to ``slice_size`` of them, fewer if only then
    its lower end lies in a gap that is wide for the interval. Equal eigenvalues stay together, however many.
    """
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    top = float((diagonal + reach).max())
    top += abs(top) * 1e-3
    wanted = min(wanted, n - int(inertia(diagonal, off, np.array([least]))[0]))
    if wanted <= 0:
        return []
    low, high = np.full(n, float((diagonal - reach).min()) - top), np.full(n, top)
    rank = n - np.arange(n)
    for _ in range(60):
        mid = (low + high) / 2
        up = inertia(diagonal, off, mid) < rank        # fewer below than the value's rank: it lies above
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    value = np.append((low + high) / 2, min(least, float(low[-1])))
    out, start, above = [], 0, top
    while start < wanted:
        ends = [j for j in range(start + 1, n + 1) if value[j - 1] - value[j] > 1e-9 * top or j == n]
        ends = [j for j in ends if j <= max(ends[0], start + slice_size)]
        width = {j: (value[j - 1] - value[j]) / (value[start] - value[j]) for j in ends}
        wide = [j for j in width if width[j] >= 0.05]
        end = max(wide) if wide else max(width, key=width.get)
        edge = (value[end - 1] + value[end]) / 2
        roof = min(above, value[start] + max(value[start] - value[end], 1e-9 * top))
        up, middle, down = inertia(diagonal, off, np.array([above, roof, edge]))
        if up != middle:
            raise ArithmeticError(f"an eigenvalue between {roof} and {above} was not placed")
        out.append(Interval(edge, roof, int(middle - down)))
        start, above = start + out[-1].count, edge
    return out


def contour_pairs(matrix: np.ndarray, part: Interval, nodes: int = NODES, rounds: int = ROUNDS,
                  seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs inside one interval, as many as its inertia count."""
    n = len(matrix)
    size = min(n, max(part.count + 4, part.count * 3 // 2))
    radius, centre = (part.high - part.low) / 2, (part.high + part.low) / 2
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi * (1 + x) / 2
    points = centre + radius * np.exp(1j * angle)
    factor = w / 2 * radius * np.exp(1j * angle)
    eye = np.eye(n)
    scale = np.abs(matrix).sum(axis=0).max()
    block = np.random.default_rng(seed).standard_normal((n, size))
    unit, last = np.finfo(float).eps * scale, np.inf
    for _ in range(rounds):
        # Half the circle is enough: the other half gives the conjugate.
        block = sum((f * np.linalg.solve(z * eye - matrix, block)).real for z, f in zip(points, factor, strict=True))
        basis, size_of, _ = np.linalg.svd(block, full_matrices=False)
        basis = basis[:, size_of > size_of[0] * 1e-13]
        small = basis.T @ matrix @ basis
        values, turn = np.linalg.eigh((small + small.T) / 2)
        block = basis @ turn
        inside = np.flatnonzero((values > part.low) & (values <= part.high))
        rest = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0)
        # Mixtures of outer eigenvectors from both sides may have a Ritz value inside: their residuals are large.
        inside = np.sort(inside[np.argsort(rest, kind="stable")[:part.count]])
        rest = np.sort(rest)[:part.count].max(initial=0)
        # Settled: at rounding level, or no longer falling just above it.
        if len(inside) == part.count and (rest <= 4 * unit or last / 2 <= rest <= 64 * n * unit):
            return values[inside], block[:, inside]
        last = rest if len(inside) == part.count else np.inf
    raise ArithmeticError(f"{len(inside)} of {part.count} eigenvalues settled in ({part.low}, {part.high}]")


def largest_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues, falling, and their unit eigenvectors (columns).

    Eigenvalues at rounding level (below 1e-13 of the trace) count as zero and are left out.
    """
    n = len(matrix)
    trace = float(np.trace(matrix)) if n else 0.0
    if trace <= 0:
        return np.zeros(0), np.zeros((n, 0))
    unit = matrix / trace
    parts = intervals(*tridiagonal(unit), wanted, 1e-13)
    found = [contour_pairs(unit, p) for p in parts]
    block = np.concatenate([v for _, v in found], axis=1) if found else np.zeros((n, 0))
    # One Rayleigh-Ritz over all intervals makes their vectors orthogonal to rounding.
    basis, _ = np.linalg.qr(block)
    small = basis.T @ unit @ basis
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * trace, (basis @ turn)[:, order]


# --- the rows

def finite_rows(df: DataFrame, vec_col: str, id_col: str) -> DataFrame:
    """``vec_id, x array<long>`` of the rows whose vector is not null and has finite entries only."""
    v = F.col(vec_col).cast("array<double>")
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))
    return (df.select(F.col(id_col).alias("vec_id"), v.alias("v"))
              .where(F.col("v").isNotNull() & ~F.exists("v", bad))
              .select("vec_id", F.transform("v", lambda e: F.floor(e * SCALE).cast("long") + SHIFT).alias("x")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the sum of every dimension, exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            lengths = b.column("x").value_lengths().to_numpy()
            for d in np.unique(lengths):
                x = _matrix(b.column("x").filter(pa.array(lengths == d)))
                n, s = sums.get(int(d), (0, [0] * int(d)))
                sums[int(d)] = (n + len(x), [a + int(c) for a, c in zip(s, x.sum(axis=0), strict=True)])
        for d, (n, s) in sums.items():
            yield pa.RecordBatch.from_pydict({"d": [d] * (d + 1), "i": range(d + 1), "s": [n, *s]},
                                             schema=pa.schema([("d", pa.int64()), ("i", pa.int64()), ("s", pa.int64())]))

    got = (rows.select("x").mapInArrow(run, "d long, i long, s long").groupBy("d", "i").agg(F.sum("s").alias("s"))
               .collect())
    if len({r.d for r in got}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({r.d for r in got})}")
    cells = {r.i: r.s for r in got}
    return cells.get(0, 0), np.array([cells[i] for i in range(1, len(cells))], object)


def _products(rows: DataFrame, map_rows, schema_d: int) -> np.ndarray:
    """Sum over all rows of ``y y^T`` and ``y`` for ``y = map_rows(x)``: a (d + 1)-square matrix with a leading
    row of ones (cell 0, 0 counts rows)."""
    size = schema_d + 1
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            y = map_rows(_matrix(b.column("x")))
            if len(y):
                y = np.concatenate([np.ones((len(y), 1)), y], axis=1)
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(upper[0])), "v": total[upper]},
                                         schema=pa.schema([("cell", pa.int64()), ("v", pa.float64())]))

    out = np.zeros((size, size))
    for r in rows.select("x").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        i, j = int(upper[0][r.cell]), int(upper[1][r.cell])
        out[i, j] = out[j, i] = r.v
    return out


def _covariance(products: np.ndarray) -> np.ndarray:
    n = products[0, 0]
    mean = products[0, 1:] / n
    return products[1:, 1:] / n - np.outer(mean, mean)


@dataclass
class Whitening:
    """A fitted model: ``n`` rows, their sums, eigenvalues (falling) and unit eigenvectors (columns)."""

    n: int
    sums: np.ndarray          # Python integers
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole number next to each dimension's mean."""
        return np.array([(2 * int(s) + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def whiten(self):
        """A function from rows ``x`` to their whitened values (rows by components)."""
        centre = self.centre
        rest = np.array([(int(s) - self.n * int(c)) / self.n for s, c in zip(self.sums, centre, strict=True)])
        turn = self.vectors / np.sqrt(self.values)
        return lambda x: (x - centre - rest) @ turn


def fit(df: DataFrame, components: int = COMPONENTS, vec_col: str = "embedding", id_col: str = "vec_id") -> Whitening:
    """Fit on all rows with a finite vector. Vectors must have one length (else ``ValueError``)."""
    small_batches(df.sparkSession, BATCH_ROWS)
    rows = finite_rows(df, vec_col, id_col)
    n, sums = _sums(rows)
    d = len(sums)
    if not n or not d:
        return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    centre = model.centre
    cov = _covariance(_products(rows, lambda x: (x - centre).astype(float), d))
    model.trace = float(np.trace(cov))
    model.values, model.vectors = largest_pairs(cov, components)
    return model


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding", id_col: str = "vec_id") -> float:
    """Largest absolute entry of the whitened rows' covariance (over all rows) minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    cov = _covariance(_products(finite_rows(df, vec_col, id_col), model.whiten(), k))
    return float(np.abs(cov - np.eye(k)).max())


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n x - S)^2``, exact; null above a long's range."""
    far = max((abs(n * int(e) - int(s)) for column, s in zip(x.T, sums, strict=True)
               for e in (column.min(), column.max())), default=0)
    if far * far * x.shape[1] < 2**63:
        a = n * x - sums.astype(np.int64)
        return (a * a).sum(axis=1).tolist()
    a = x.astype(object) * n - sums
    return [v if v < 2**63 else None for v in (a * a).sum(axis=1)]


def whiten(df: DataFrame, model: Whitening, error: float, vec_col: str = "embedding",
           id_col: str = "vec_id") -> DataFrame:
    """One row per row with a finite vector and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``.

    Rows whose vector is null or holds null, NaN or infinite entries are
    dropped. Repeated rows and null ids are rows like any other. There are at
    most as many components as positive eigenvalues: none (and no rows) if all
    vectors are equal, for a single row and for an empty table. Equal
    eigenvalues: any orthonormal basis of their space, the same for all rows.
    ``deviation`` is null beyond the range of a long (from about 10^8 rows on).
    Other columns are not read.
    """
    small_batches(df.sparkSession, BATCH_ROWS)
    rows = finite_rows(df, vec_col, id_col)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, deviation long, whitened array<double>"
    if not len(model.values):
        rows = rows.where(F.lit(False))
    n, sums, turn = model.n, model.sums, model.whiten() if len(model.values) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"))
                w = turn(x)
                values = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel())
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(_deviation(x, n, sums), pa.int64()), values],
                                                 names=["vec_id", "deviation", "whitened"])

    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if len(model.values) else F.array(F.lit(0.0))
    return (rows.mapInArrow(run, schema)
                .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
                .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                        "deviation", "whitened", F.get(share, F.col("at")).alias("explained"),
                        F.lit(error).cast("double").alias("identity_error")))


def fit_and_whiten(df: DataFrame, components: int = COMPONENTS, vec_col: str = "embedding",
                   id_col: str = "vec_id") -> DataFrame:
    model = fit(df, components, vec_col, id_col)
    return whiten(df, model, identity_error(df, model, vec_col, id_col), vec_col, id_col)
