"""Whitening of embeddings by principal components, found by contour integration (FEAST).

Entries become integers, and each distinct vector counts once. Sums are exact, vectors
are centred exactly (``n * x - sum`` in integers) before they are multiplied, and tasks add
up partial matrices. What reaches the driver is one matrix of the size of a vector
squared, whatever the number of rows (``most_dimensions`` bounds it).

The wanted eigenvalues are first fenced in. The inertia of ``V - shift * I`` (Sylvester)
counts the eigenvalues above a shift; Spark tasks count for many shifts at a time, until
a shift parts the wanted ones from the rest and intervals of few eigenvalues are known
together with their counts. Every interval then has a subspace that is filtered by the
spectral projector, a quadrature over complex shifted solves on a circle around the
interval, one task per interval and node. A Rayleigh-Ritz step takes eigenpairs from the
subspace; the step is repeated, and the subspace enlarged, until there are just as many
eigenvalues in the interval as counted, all with residuals at rounding level. One more
Rayleigh-Ritz step over all intervals makes the components orthonormal.

Defined results: rows whose vector is NULL, holds NULL, NaN or infinite entries, or has
another length than most vectors (the longer one among equals) are left out. Entries
beyond +-2**45 / ``scale`` count as that. A NULL id is an id; repeated rows each have a result. A component whose
eigenvalue is at most 1e-10 of the largest cannot be whitened and is left out, so equal
vectors only, or an empty table, give no component. Components of equal eigenvalues are any
orthonormal ones. A deviation that exceeds a long is NULL. Other columns stay as they are, but for those of the names of the two new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import stored

LARGEST = 1 << 45
EPS = float(np.finfo(np.float64).eps)


def codes(vector: Column, scale: int, offset: int) -> Column:
    """Entries as whole numbers: floor(scale * entry) + offset."""

    def code(entry: Column) -> Column:
        value = F.greatest(F.least(entry.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
        return F.floor(value) + offset

    return F.transform(vector, code)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""

    def odd(entry: Column) -> Column:
        value = entry.cast("double")
        return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    return vector.isNotNull() & F.coalesce(~F.exists(vector, odd), F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


@dataclass(frozen=True)
class Centre:
    """Exact centring: ``rows * x - sums`` for integer vectors ``x``."""

    rows: int
    sums: tuple[int, ...]
    reach: int  # largest distance of an entry from the floor of its mean

    def scaled(self, x: np.ndarray) -> np.ndarray:
        base = [s // self.rows for s in self.sums]
        rest = [s - self.rows * b for s, b in zip(self.sums, base)]
        near = x - np.array(base, np.int64)
        if self.rows * (self.reach + 1) >= 1 << 62:
            return near.astype(object) * self.rows - np.array(rest, object)
        return near * self.rows - np.array(rest, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.rows

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of squares of ``rows * x - sums`` per vector."""
        scaled = self.scaled(x)
        if (self.rows * (self.reach + 1)) ** 2 * max(1, len(self.sums)) < 1 << 62:
            return pa.array((scaled * scaled).sum(axis=1), pa.int64())
        exact = [sum(int(v) ** 2 for v in row) for row in scaled]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    components: np.ndarray  # one unit column per component
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    scale: int
    offset: int
    vector_col: str

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]

    def transform(self, vectors: DataFrame) -> DataFrame:
        """The rows that are not left out, with ``deviation`` and ``whitened`` (an array)."""
        size = len(self.centre.sums)
        centre, project = self.centre, self.components / np.sqrt(self.eigenvalues)
        kept = vectors.filter(usable(F.col(self.vector_col)) & (F.size(self.vector_col) == size))
        kept = kept.drop("deviation", "whitened")

        @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
        def measured(column: pa.Array) -> pa.Array:
            if not size:
                empty = pa.array([[]] * len(column), pa.list_(pa.float64()))
                return pa.StructArray.from_arrays(
                    [pa.array([0] * len(column), pa.int64()), empty], ["deviation", "whitened"]
                )
            x = matrix(column, size)
            values = centre.centred(x) @ project
            ends = np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]
            return pa.StructArray.from_arrays(
                [centre.deviations(x), pa.ListArray.from_arrays(ends, values.ravel())],
                ["deviation", "whitened"],
            )

        name = "whitening__"
        found = kept.withColumn(name, measured(codes(F.col(self.vector_col), self.scale, self.offset)))
        return found.select(
            *(kept[c] for c in kept.columns),
            F.col(f"{name}.deviation").alias("deviation"),
            F.col(f"{name}.whitened").alias("whitened"),
        )


def fit_whitening(
    vectors: DataFrame,
    components: int = 16,
    vector_col: str = "embedding",
    scale: int = 64,
    offset: int = 1_000_000,
    most_dimensions: int = 4096,
) -> Whitening:
    """Centre, components and eigenvalues of the distinct coded vectors."""
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    valid = vectors.filter(usable(vector)).select(codes(vector, scale, offset).alias("x"))
    lengths = valid.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    commonest = lengths.orderBy(F.desc("rows"), F.desc("size")).first()
    size = commonest.size if commonest else 0
    if size > most_dimensions:
        raise ValueError(f"{size} dimensions: their covariance exceeds the bound of {most_dimensions}")
    if not size:
        nothing = np.zeros((0, 0))
        return Whitening(Centre(0, (), 0), nothing, np.zeros(0), 0.0, 0.0, scale, offset, vector_col)
    fit_list = stored(valid.filter(F.size("x") == size).distinct())
    centre = _centre(fit_list, size)
    covariance = _covariance(fit_list, size, centre.centred, size, centre.rows)
    values, found = leading_eigenpairs(spark, covariance, components)
    project = found / np.sqrt(values)
    error = 0.0
    if len(values):
        white = _covariance(
            fit_list, size, lambda x: centre.centred(x) @ project, len(values), centre.rows
        )
        error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(
        centre, found, values, float(np.trace(covariance)), error, scale, offset, vector_col
    )


def _centre(fit_list: DataFrame, size: int) -> Centre:
    """Exact sums and the range per dimension: one short row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), size)
            if len(x):
                yield pa.RecordBatch.from_pydict(
                    {
                        "place": np.arange(size),
                        "rows": np.full(size, len(x)),
                        "total": x.sum(axis=0),
                        "low": x.min(axis=0),
                        "high": x.max(axis=0),
                    }
                )

    parts = fit_list.mapInArrow(run, "place long, rows long, total long, low long, high long")
    rows = (
        parts.groupBy("place")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .orderBy("place")
        .collect()
    )
    n, sums = rows[0].rows, tuple(int(r.total) for r in rows)
    reach = max(max(r.high - s // n, s // n - r.low) for r, s in zip(rows, sums))
    return Centre(n, sums, reach)


def _covariance(
    fit_list: DataFrame, size: int, values: Callable[[np.ndarray], np.ndarray], width: int, n: int
) -> np.ndarray:
    """Covariance of ``values(x)``, whose sum is nearly zero, from partial sums per task."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, seen = np.zeros((width, width)), np.zeros(width), False
        for batch in batches:
            if batch.num_rows:
                y = values(matrix(batch.column("x"), size))
                products += y.T @ y
                sums += y.sum(axis=0)
                seen = True
        if seen:
            cells = np.concatenate([products[upper], sums])
            yield pa.RecordBatch.from_pydict({"place": np.arange(len(cells)), "value": cells})

    parts = fit_list.mapInArrow(run, "place long, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    cells = np.zeros(len(upper[0]) + width)
    for row in rows:
        cells[row.place] = row.value
    means = cells[len(upper[0]) :] / n
    found = np.zeros((width, width))
    found[upper] = cells[: len(upper[0])] / n - means[upper[0]] * means[upper[1]]
    return np.triu(found) + np.triu(found, 1).T


def eigenvalues_above(symmetric: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: positive pivots of a symmetric indefinite
    factorisation with pivots of one or two rows."""
    a = symmetric - shift * np.eye(len(symmetric))
    part = (1 + 17**0.5) / 8  # bounds the growth of elements
    above, k, n = 0, 0, len(a)

    def swap(i: int, j: int) -> None:
        a[[i, j], :] = a[[j, i], :]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        two = False
        if k + 1 < n:
            below = np.abs(a[k + 1 :, k])
            r = int(below.argmax()) + k + 1
            largest, here = below[r - k - 1], abs(a[k, k])
            if here < part * largest:
                others = np.abs(a[r, k:])
                others[r - k] = 0
                widest = others.max()
                if here * widest < part * largest * largest:
                    two = abs(a[r, r]) < part * widest
                    swap(k + 1 if two else k, r)
        if two:
            pivot, rest = a[k : k + 2, k : k + 2].copy(), a[k + 2 :, k : k + 2].copy()
            determinant = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] * pivot[1, 0]
            above += 1 if determinant < 0 else 2 * int(pivot[0, 0] > 0)
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(pivot, rest.T)
            k += 2
            continue
        above += int(a[k, k] > 0)
        if a[k, k] != 0:
            column = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(column, column / a[k, k])
        k += 1
    return above


class Spectrum:
    """Counts and filtered subspaces of one symmetric matrix, made by Spark tasks."""

    def __init__(self, spark: SparkSession, symmetric: np.ndarray):
        self.spark, self.matrix, self.size = spark, symmetric, len(symmetric)
        self.norm = float(np.abs(symmetric).sum(axis=1).max())
        # At most ``most_dimensions`` squared numbers.
        self.shared = spark.sparkContext.broadcast(symmetric.tobytes())

    def _run(self, count: int, work: Callable[[int, np.ndarray], bytes]) -> list[bytes]:
        """``work(i, matrix)`` for i below ``count``, each in some task."""
        shared, size = self.shared, self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = np.frombuffer(shared.value).reshape(size, size)
            for batch in batches:
                places = batch.column("id").to_pylist()
                yield pa.RecordBatch.from_pydict(
                    {"id": pa.array(places, pa.int64()), "out": pa.array([work(i, whole) for i in places], pa.binary())}
                )

        tasks = min(count, self.spark.sparkContext.defaultParallelism)
        rows = self.spark.range(0, count, 1, tasks).mapInArrow(run, "id long, out binary").collect()
        return [bytes(r.out) for r in sorted(rows, key=lambda r: r.id)]

    def counts(self, shifts: list[float]) -> list[int]:
        def work(i: int, whole: np.ndarray) -> bytes:
            return str(eigenvalues_above(whole, shifts[i])).encode()

        return [int(c) for c in self._run(len(shifts), work)]

    def filtered(
        self, intervals: list[tuple[float, float]], subspaces: list[np.ndarray], nodes: int
    ) -> list[np.ndarray]:
        """Each subspace times the quadrature of its interval's spectral projector."""
        places, weights = np.polynomial.legendre.leggauss(nodes)
        shared = self.spark.sparkContext.broadcast(subspaces)

        def work(i: int, whole: np.ndarray) -> bytes:
            which, node = divmod(i, nodes)
            low, high = intervals[which]
            turn = (high - low) / 2 * np.exp(0.5j * np.pi * (1 + places[node]))
            shifted = ((low + high) / 2 + turn) * np.eye(len(whole)) - whole
            solved = turn * np.linalg.solve(shifted, shared.value[which].astype(complex))
            return (weights[node] / 2 * solved.real).tobytes()

        parts = self._run(len(intervals) * nodes, work)
        found = []
        for which, start in enumerate(subspaces):
            mine = parts[which * nodes : (which + 1) * nodes]
            found.append(sum(np.frombuffer(p).reshape(start.shape) for p in mine))
        shared.unpersist()
        return found


def _fences(spectrum: Spectrum, wanted: int, grid: int) -> list[tuple[float, int]]:
    """(shift, eigenvalues above it), rising shifts: the first one has the wanted
    eigenvalues above it and no more, unless they cannot be told from the next ones."""
    top = spectrum.norm * (1 + 8 * EPS)
    known = {top: 0}
    lowest = 1e-10 * spectrum.norm
    low, high = lowest, top
    while True:
        # Narrow brackets anywhere in the range: steps of equal ratio.
        shifts = sorted(set(np.geomspace(low, high, grid).tolist()) - set(known))
        known.update(zip(shifts, spectrum.counts(shifts)))
        rising = sorted(known.items())
        if rising[0][1] <= wanted:
            cut = rising[0][0]
            break
        exact = [s for s, c in rising if c == wanted]
        if exact:
            cut = exact[len(exact) // 2]
            break
        low = max(s for s, c in rising if c > wanted)
        high = min(s for s, c in rising if c < wanted)
        if high - low <= 16 * EPS * spectrum.norm or not shifts:
            cut = low
            break
    return [(s, c) for s, c in rising if s >= cut]


def _intervals(fences: list[tuple[float, int]], most: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between), each with few eigenvalues where fences allow it."""
    middle: dict[int, list[float]] = {}
    for shift, count in fences:
        middle.setdefault(count, []).append(shift)
    # Of equal counts the middle shift is the farthest from eigenvalues; ends stay.
    cuts = {c: s[len(s) // 2] for c, s in middle.items()}
    cuts[fences[0][1]], cuts[fences[-1][1]] = fences[0][0], fences[-1][0]
    levels = sorted(cuts)
    found, last = [], levels[0]
    for level, after in zip(levels[1:], [*levels[2:], None]):
        if after is None or after - last > most:
            found.append((cuts[level], cuts[last], level - last))
            last = level
    return [i for i in found if i[2]]


def leading_eigenpairs(
    spark: SparkSession,
    symmetric: np.ndarray,
    wanted: int,
    nodes: int = 8,
    most: int = 8,
    grid: int = 64,
    steps: int = 60,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) of a positive semidefinite matrix and
    their unit eigenvectors; fewer if the others are zero against the largest."""
    size = len(symmetric)
    spectrum = Spectrum(spark, symmetric)
    if not spectrum.norm:
        return np.zeros(0), np.zeros((size, 0))
    # The norm bounds the largest eigenvalue, and is at most sqrt(size) times it.
    fences = _fences(spectrum, min(wanted, size), grid)
    todo = _intervals(fences, most)
    expected = sum(i[2] for i in todo)
    random = np.random.default_rng(0)
    spaces = [random.standard_normal((size, min(size, i[2] * 3 // 2 + 4))) for i in todo]
    done: list[np.ndarray | None] = [None] * len(todo)
    before = [np.inf] * len(todo)
    tight = 64 * EPS * spectrum.norm
    for _ in range(steps):
        open_ = [i for i, d in enumerate(done) if d is None]
        if not open_:
            break
        images = spectrum.filtered([todo[i][:2] for i in open_], [spaces[i] for i in open_], nodes)
        for i, image in zip(open_, images):
            low, high, count = todo[i]
            values, vectors = _ritz(symmetric, image)
            inside = (values > low) & (values <= high)
            residual = symmetric @ vectors[:, inside] - vectors[:, inside] * values[inside]
            worst = float(np.sqrt((residual**2).sum(axis=0)).max(initial=0))
            if inside.sum() == count and worst <= tight:
                done[i] = vectors[:, inside]
                continue
            spaces[i] = vectors
            if (inside.sum() != count or worst > 0.1 * before[i]) and vectors.shape[1] < size:
                more = min(size - vectors.shape[1], max(4, vectors.shape[1] // 2))
                spaces[i] = np.hstack([vectors, random.standard_normal((size, more))])
            before[i] = worst if inside.sum() == count else np.inf
    if any(d is None for d in done):
        raise RuntimeError("eigenvalues of an interval were not all found")
    if not done:
        return np.zeros(0), np.zeros((size, 0))
    values, vectors = _ritz(symmetric, np.hstack(done))
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    if len(values) != expected or spectrum.counts([fences[0][0]])[0] != expected:
        raise RuntimeError("the number of eigenvalues differs from the inertia")
    keep = (values > 1e-10 * values[0]) & (np.arange(len(values)) < wanted)
    return values[keep], vectors[:, keep]


def _ritz(symmetric: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``symmetric`` within the span of ``space``."""
    basis, _ = np.linalg.qr(space)
    basis, _ = np.linalg.qr(basis)
    inner = basis.T @ symmetric @ basis
    values, turned = np.linalg.eigh((inner + inner.T) / 2)
    return values, basis @ turned
