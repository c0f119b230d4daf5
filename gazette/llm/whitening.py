"""Whitening of vectors by eigenvectors refined from single precision.

Components become whole numbers, so the sums and the covariance of all rows are
gathered exactly: the same in any order, on any partitioning and after a retry.
The eigenvectors start as those of the covariance in float32 and are corrected
by the iteration of Ogita and Aishima, matrix products in extended precision
that square the error of a step. Eigenvalues that lie too close together for the
correction are told apart by solving the small problem of their subspace.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.session import run_dir

WIDE = np.longdouble
#: Iterations at most; each squares the error, float32 needs three or four.
ITERATIONS = 30
#: Rows of a matrix product, and size up to which it is exact in float64.
ROWS, EXACT = 1 << 12, 1 << 20
#: Partial results that are added up before the driver reads them.
GROUPS = 32
#: Entries may not be larger.
LARGEST = 1 << 40
LOW = (1 << 31) - 1
PARTIAL = "task int, body binary"
PROJECTED = "vec_id long, deviation long, whitened array<double>"


def whole_vectors(embeddings: DataFrame, scale: int, shift: int) -> DataFrame:
    """vec_id and the components as whole numbers floor(scale * c) + shift.

    Rows whose embedding is null or holds null or non-finite components are left out.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.coalesce(usable, F.lit(False)))
    # far beyond what is refused later, so that nothing overflows before
    end = F.lit(4.0 * LARGEST)
    scaled = F.transform("embedding", lambda x: F.greatest(F.least(x * F.lit(float(scale)), end), -end))
    moved = F.transform(scaled, lambda x: F.floor(x) + F.lit(shift))
    return kept.select("vec_id", moved.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], name: str, kind) -> Iterator[np.ndarray]:
    for batch in batches:
        for i in range(0, len(batch), ROWS):
            piece = batch.slice(i, ROWS)[name]
            if len(piece):
                yield piece.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(piece), -1)


def exact_product(z: np.ndarray) -> np.ndarray:
    """z' z of whole numbers, as two arrays: the multiples of 2^31 and the rest.

    Float64 products are exact while sums stay below 2^53; larger numbers are cut
    into a high and a low part first.
    """
    if np.abs(z).max(initial=0) < EXACT:
        whole = (z.T.astype(float) @ z.astype(float)).astype(np.int64)
        return np.stack([whole >> 31, whole & LOW])
    high, low = z >> 15, z & 0x7FFF  # z = high * 2^15 + low, 0 <= low < 2^15
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for a, b, power in ((high, high, 30), (high, low, 15), (low, high, 15), (low, low, 0)):
        for i in range(0, len(z), 1 << 9):  # |high| <= 2^26, so sums stay below 2^62
            total += (a[i : i + (1 << 9)].T @ b[i : i + (1 << 9)]).astype(object) << power
    return np.stack([(total >> 31).astype(np.int64), (total & LOW).astype(np.int64)])


def _added(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of partial arrays of whole numbers, as Python numbers.

    parts: task, body (int64: multiples of 2^31, then the rest). They are added in
    GROUPS tasks first, so the driver reads a bounded number of them.
    """

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = np.zeros((2, int(np.prod(shape))), np.int64)
        for body in table["body"]:
            total += np.frombuffer(body.as_py(), np.int64).reshape(2, -1)
            total[0] += total[1] >> 31
            total[1] &= LOW
        return pa.table({"task": pa.array([0], pa.int32()), "body": pa.array([total.tobytes()], pa.binary())})

    grouped = parts.groupBy(F.pmod("task", F.lit(GROUPS))).applyInArrow(add, PARTIAL)
    total = np.zeros(int(np.prod(shape)), object)
    for row in grouped.toArrow()["body"].to_pylist():
        high, low = np.frombuffer(row, np.int64).reshape(2, -1)
        total += (high.astype(object) << 31) + low.astype(object)
    return total.reshape(shape)


def _partial(rows: DataFrame, name: str, act, width: int) -> DataFrame:
    """One array of whole numbers per task: the sum of act(matrix) over its rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((2, width), np.int64)
        for z in _matrices(batches, name, np.int64):
            total += act(z).reshape(2, -1)
            total[0] += total[1] >> 31
            total[1] &= LOW
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            ["task", "body"],
        )

    return rows.select(name).mapInArrow(apply, PARTIAL)


class Moments:
    """n, the sums of each dimension, and n^2 times the covariance, all exact."""

    def __init__(self, n: int, sums: list[int], spread: np.ndarray):
        self.n, self.sums, self.spread = n, sums, spread

    def covariance(self) -> np.ndarray:
        """In extended precision; each entry is rounded once."""
        square = self.n * self.n
        return np.array(
            [[_wide(Fraction(int(v), square)) for v in row] for row in self.spread], WIDE
        ).reshape(self.spread.shape)


def _wide(value: Fraction) -> np.longdouble:
    first = float(value)
    return WIDE(first) + WIDE(float(value - Fraction(first)))


def moments(whole: DataFrame) -> Moments:
    """Exact sums of whole vectors (x), then exact products of centred ones.

    Rows are centred by the nearest whole number to the mean before they are
    multiplied; the rest of the mean, at most a half, is taken off exactly.
    """
    reach = F.aggregate("x", F.lit(0).cast("long"), lambda m, v: F.greatest(m, v, -v))
    n, least, dims, largest = whole.agg(
        F.count("*"), F.min(F.size("x")), F.max(F.size("x")), F.max(reach)
    ).first()
    if least != dims:
        raise ValueError(f"vectors have {least} to {dims} components")
    if not dims:
        return Moments(n, [], np.zeros((0, 0), object))
    if largest >= LARGEST:
        raise ValueError(f"a component is {largest}, {LARGEST} or more after scaling")

    def summed(z: np.ndarray) -> np.ndarray:
        total = z.sum(0)
        return np.stack([total >> 31, total & LOW])

    sums = [int(s) for s in _added(_partial(whole, "x", summed, dims), (dims,))]
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)

    def multiplied(z: np.ndarray) -> np.ndarray:
        return exact_product(z - middle)

    products = _added(_partial(whole, "x", multiplied, dims * dims), (dims, dims))
    rest = np.array([s - n * int(m) for s, m in zip(sums, middle, strict=True)], object)
    return Moments(n, sums, n * products - np.multiply.outer(rest, rest))


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of eigenvalues, given in falling order, whose steps are at most gap."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > gap) + 1
    return np.split(np.arange(len(values)), cuts)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Newton's steps to the nearest orthonormal columns, from nearly orthonormal ones."""
    for _ in range(3):
        x = x @ (WIDE(1.5) * np.eye(x.shape[1], dtype=WIDE) - x.T @ x / 2)
    return x


def eigen(matrix: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues in falling order, unit eigenvectors (columns), iterations.

    matrix: symmetric, in extended precision. Starts from float32; a step finds the
    correction from R = I - X'X and S = X'AX, entry by entry where the eigenvalues
    are apart, and by solving X_c'(A - m)X_c for the columns c of a cluster, scaled
    so that single precision sees its differences.
    """
    n = len(matrix)
    if n == 0:
        return np.zeros(0, WIDE), np.zeros((0, 0), WIDE), 0
    scale = np.abs(matrix).max()
    if scale == 0:
        return np.zeros(n, WIDE), np.eye(n, dtype=WIDE), 0
    a = matrix / scale
    start = np.linalg.eigh(a.astype(np.float32))[1]
    x = start[:, ::-1].astype(WIDE)
    small = n * np.finfo(WIDE).eps
    last = np.inf
    for turn in range(1, ITERATIONS + 1):
        r = np.eye(n, dtype=WIDE) - x.T @ x
        s = x.T @ a @ x
        s, r = (s + s.T) / 2, (r + r.T) / 2  # else the correction of close pairs is no rotation
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = s - np.diag(values)
        error = 2 * (_norm(off) + _norm(a) * _norm(r))
        apart = values[None, :] - values[:, None]
        clear = np.abs(apart) > error
        fix = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
        x = x + x @ fix
        groups = [g for g in _clusters(values, error) if len(g) > 1]
        if groups and depth < 3:
            for g in groups:
                own = _orthonormal(x[:, g])
                # rayleigh quotients of the cluster about its middle, scaled up
                middle = values[g].mean()
                inner = own.T @ (a @ own - middle * own)
                if np.abs(inner).max() > small:
                    own = own @ eigen((inner + inner.T) / 2, depth + 1)[1]
                x[:, g] = own
        # what is left is rounding: it no longer shrinks, far below single precision
        if error <= small or (error >= last / 4 and error < 1e-14):
            break
        last = error
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order], turn


def _norm(matrix: np.ndarray) -> float:
    """An upper bound of the spectral norm of a symmetric matrix."""
    return np.abs(matrix).sum(1).max(initial=0)


class Whitening:
    """What the fit found: moments, eigenvalues and unit eigenvectors (columns)."""

    def __init__(self, found: Moments, values: np.ndarray, vectors: np.ndarray, trace: np.longdouble):
        self.moments, self.values, self.vectors, self.trace = found, values, vectors, trace


def fit(whole: DataFrame, components: int = 32) -> Whitening:
    """The first components of all whole vectors.

    Components whose eigenvalue is nothing but rounding (the table has fewer
    independent directions) are left out. The driver holds matrices of dims by dims.
    """
    found = moments(whole)
    matrix = found.covariance()
    values, vectors, _ = eigen(matrix)
    trace = np.trace(matrix) if len(matrix) else WIDE(0)
    real = values > len(values) * np.finfo(float).eps * (values[0] if len(values) else 0)
    count = min(components, int(real.sum()))
    return Whitening(found, values[:count], vectors[:, :count], trace)


def projected(whole: DataFrame, white: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened components of each vector, in the scan.

    deviation is null where it does not fit 64 bits.
    """
    n, sums = white.moments.n, white.moments.sums
    exact = np.array(sums, object)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums] if n else [], np.int64)
    rest = np.array([s - n * int(m) for s, m in zip(sums, middle, strict=True)], object)
    basis = (white.vectors / np.sqrt(white.values)).astype(float)
    count = basis.shape[1]
    small = (rest / n).astype(float) if n else np.zeros(0)

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                piece = batch.slice(i, ROWS)
                if not len(piece):
                    continue
                x = piece["x"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                x = x.reshape(len(piece), -1)
                z = x - middle
                reach = n * (int(np.abs(z).max(initial=0)) + 1)
                if reach * reach * max(1, x.shape[1]) < 1 << 63:
                    apart = ((n * z - rest.astype(np.int64)) ** 2).sum(1).tolist()
                else:
                    wide = n * x.astype(object) - exact
                    apart = [v if v < 1 << 63 else None for v in (wide * wide).sum(1)]
                values = (z - small) @ basis
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(z) + 1) * count, pa.int32()), pa.array(values.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [piece["vec_id"], pa.array(apart, pa.int64()), lists],
                    ["vec_id", "deviation", "whitened"],
                )

    return whole.mapInArrow(act, PROJECTED)


def _merged(parts: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Counts, means and centred products of several groups of rows, as one."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    spread = sum(p[2] + p[0] * np.outer(p[1] - mean, p[1] - mean) for p in parts)
    return n, mean, spread


def _packed(n: float, mean: np.ndarray, spread: np.ndarray) -> bytes:
    return np.concatenate([[n], mean, spread.reshape(-1)]).tobytes()


def _unpacked(body: bytes, width: int) -> tuple[float, np.ndarray, np.ndarray]:
    flat = np.frombuffer(body, float)
    return flat[0], flat[1 : width + 1], flat[width + 1 :].reshape(width, width)


def covariance(rows: DataFrame, name: str, width: int) -> np.ndarray:
    """The covariance (divisor n) of an array column, each block centred before it is multiplied."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for w in _matrices(batches, name, float):
            mean = w.mean(0)
            own = (float(len(w)), mean, (w - mean).T @ (w - mean))
            total = own if total is None else _merged([total, own])
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([_packed(*total)], pa.binary())],
                ["task", "body"],
            )

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        whole = _merged([_unpacked(b, width) for b in sorted(table["body"].to_pylist())])
        return pa.table({"task": pa.array([0], pa.int32()), "body": pa.array([_packed(*whole)], pa.binary())})

    parts = rows.select(name).mapInArrow(act, PARTIAL)
    bodies = parts.groupBy(F.pmod("task", F.lit(GROUPS))).applyInArrow(add, PARTIAL).toArrow()["body"]
    found = [_unpacked(b, width) for b in sorted(bodies.to_pylist())]
    if not found:
        return np.zeros((width, width))
    n, _, spread = _merged(found)
    return spread / n


def whitened(
    embeddings: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """Vectors (vec_id, embedding) on the first components of their covariance, at unit variance.

    Returns one row per vector and component: vec_id, component (from 1, by falling
    eigenvalue), n, deviation (exact sum over dimensions of (n x - S)^2; null where
    it does not fit 64 bits), whitened, explained (share of the trace) and
    identity_error (of all rows: how far their covariance is from the identity).
    Rows whose embedding is null or holds null or non-finite components are dropped.
    Rows that share a vec_id, or have none, are separate vectors. Components of no
    variance have no rows, so a single vector or equal ones give none, nor does an
    empty table. Equal eigenvalues (ties) get some orthonormal basis, the same for
    all rows. Vectors of different lengths or with entries of LARGEST or more are
    an error. Other columns are not read.

    The table is scanned for its sizes, sums and products, and once to be projected;
    tasks hand on one matrix each, the projections are written to the shared folder.
    """
    spark = embeddings.sparkSession
    whole = whole_vectors(embeddings, scale, shift)
    white = fit(whole, components)
    path = f"{run_dir(spark, 'whitened')}/rows"
    projected(whole, white).write.parquet(path)
    rows = spark.read.parquet(path)
    count = len(white.values)
    apart = np.abs(covariance(rows, "whitened", count) - np.eye(count)).max(initial=0.0)
    share = [float(v / white.trace) for v in white.values]
    shares = F.array(*[F.lit(s) for s in share]) if share else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(white.moments.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(float(apart)).alias("identity_error"),
    )
