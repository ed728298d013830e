"""Embedding whitening by FEAST contour integration.

The covariance of the distinct vectors is summed by Spark, d by d numbers whatever the rows. Its
largest eigenvalues are fenced off by inertia counts; for each slice the quadrature of complex
shifted solves around it projects random vectors onto the slice's eigenvectors, Rayleigh-Ritz
extracts them, and the inertia count says whether one is missing. Spark then projects every row.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from navlake.llm.common import cut

#: An entry c becomes the whole number floor(SCALE * c).
SCALE = 256

#: Whole numbers from here on, either sign, don't fit a long; their rows count as not finite.
LIMIT = float(1 << 62)

#: Eigenvalues of one slice at most, unless they are equal; points of a half circle.
SLICE = 16
NODES = 8

#: Relative size below which an eigenvalue counts as nought.
NOUGHT = 1e-12


# Eigenpairs of a symmetric matrix, all d by d or smaller.

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the matrix after Householder reflections."""
    a = np.array(v, dtype=float)
    for i in range(len(a) - 2):
        x = a[i + 1:, i].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x /= size
        part = a[i + 1:, :]
        part -= 2 * np.outer(x, x @ part)
        part = a[:, i + 1:]
        part -= 2 * np.outer(part @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the shifted matrix, by its inertia."""
    diagonal, off = form
    tiny = np.finfo(float).tiny * 1e20
    above, pivot = 0, 1.0
    for i, entry in enumerate(diagonal):
        pivot = entry - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def fence(form, count: int, low: float, high: float) -> tuple[float, int]:
    """A shift with ``count`` eigenvalues above it, or just more where some are equal."""
    n_low = count_above(form, low)
    while high - low > 4 * np.finfo(float).eps * max(abs(low), abs(high)):
        middle = (low + high) / 2
        above = count_above(form, middle)
        if above == count:
            return middle, above
        if above > count:
            low, n_low = middle, above
        else:
            high = middle
    # Equal eigenvalues lie just above: the fence moves down as far as none is passed.
    step = low * 1e-14
    while step < low and count_above(form, low - 2 * step) == n_low:
        step *= 2
    return low - step, count_above(form, low - step)


def feast(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high], falling, and their unit eigenvectors.

    The subspace is a half larger than the count and grows where the slice's count is not
    reached; one as large as the matrix holds everything.
    """
    d, norm = len(v), max(np.linalg.norm(v, 1), np.finfo(float).tiny)
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(-0.5j * np.pi * (points - 1))
    middle, radius = (low + high) / 2, (high - low) / 2
    size = min(d, count + max(4, count // 2))
    while True:
        basis = np.random.default_rng(7).standard_normal((d, size))
        last = np.inf
        for _ in range(30):
            projected = np.zeros_like(basis)
            for turn, weight in zip(turns, weights):
                solved = np.linalg.solve((middle + radius * turn) * np.eye(d) - v, basis)
                projected += 0.5 * weight * (radius * turn * solved).real
            q, _ = np.linalg.qr(projected)
            values, inner = np.linalg.eigh(q.T @ v @ q)  # of the subspace's size
            basis = q @ inner
            inside = (values > low) & (values <= high)
            rest = v @ basis[:, inside] - basis[:, inside] * values[inside]
            worst = np.abs(rest).max(initial=0.0) / norm
            done = inside.sum() == count and (worst < 1e-15 or worst >= last / 2 and worst < 1e-12)
            if done:
                return values[inside][::-1], basis[:, inside][:, ::-1]
            last = worst if inside.sum() == count else np.inf
        if size == d:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues found between {low} and {high}")
        size = min(d, 2 * size)


def largest(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues above nought, falling, and their vectors as columns."""
    reach = np.abs(v).sum(axis=1).max(initial=0.0)
    if not reach > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    v = v / reach
    form = tridiagonal(v)
    count = min(count, count_above(form, NOUGHT))
    values, vectors, high, have = [], [], 1.0001, 0
    while have < count:
        low, above = fence(form, min(count, have + SLICE), NOUGHT / 2, high)
        found, columns = feast(v, low, high, above - have)
        values.append(found)
        vectors.append(columns)
        high, have = low, above
    values, vectors = reach * np.concatenate(values)[:count], np.hstack(vectors)[:, :count]
    heaviest = vectors[np.abs(vectors).argmax(axis=0), np.arange(count)]
    return values, vectors * np.sign(heaviest)


# Rows to whole numbers, batch by batch.

def _numbers(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole numbers (rows by dimensions), for each length among the rows."""
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
    starts = np.cumsum(lens) - lens
    sound = np.isfinite(flat) & (np.abs(flat) < LIMIT)
    for d in np.unique(lens[lens > 0]):
        rows = np.flatnonzero(lens == d)
        places = starts[rows][:, None] + np.arange(d)
        good = sound[places].all(axis=1)
        if good.any():
            yield rows[good], flat[places[good]].astype(np.int64)


def _packed(frame: DataFrame, column: str) -> DataFrame:
    """``d, x``: the length and the whole numbers of each usable vector, two or eight bytes each."""

    def pack(batches):
        for batch in batches:
            for _, x in _numbers(batch.column(0)):
                lean = (np.abs(x) < 1 << 15).all(axis=1)
                out = [row.astype("<i2").tobytes() if s else row.astype("<i8").tobytes() for row, s in zip(x, lean)]
                yield pa.record_batch([pa.array([x.shape[1]] * len(out), pa.int32()), pa.array(out, pa.binary())], ["d", "x"])

    vectors = frame.select(F.col(column).cast("array<double>").alias("v"))
    return vectors.mapInArrow(pack, "d int, x binary")


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    values = column.to_pylist()
    lean = [v for v in values if len(v) == 2 * d]
    wide = [v for v in values if len(v) != 2 * d]
    parts = [np.frombuffer(b"".join(lean), "<i2").astype(np.int64), np.frombuffer(b"".join(wide), "<i8")]
    return np.concatenate(parts).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors there are, and their sums."""

    def add(batches):
        n, total = 0, np.zeros(d, dtype=object)
        for batch in batches:
            x = _unpacked(batch.column(0), d)
            n += len(x)
            exact = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
            total = total + (x if exact else x.astype(object)).sum(axis=0)
        if n:
            yield pa.record_batch([
                pa.array(range(-1, d), pa.int32()), pa.array([str(n), *map(str, total.tolist())])], ["place", "total"])

    parts = fit.select("x").mapInArrow(add, "place int, total string")
    rows = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["place"]: int(r["total"]) for r in rows.collect()}  # one row a dimension
    return found[-1], [found[i] for i in range(d)]


def _products(fit: DataFrame, d: int, centre: np.ndarray) -> np.ndarray:
    """Sums of the products of centred entries; whole numbers, exact below 2 ** 53."""

    def multiply(batches):
        total = np.zeros((d, d))
        for batch in batches:
            z = (_unpacked(batch.column(0), d) - centre).astype(float)
            total += z.T @ z
        i, j = np.triu_indices(d)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    parts = fit.select("x").mapInArrow(multiply, "i int, j int, s double")
    total = np.zeros((d, d))
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # d by d, halved
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["s"]
    return total


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with sums ``sums``; ``axes`` (d by k) takes a centred row to its whitened one."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def axes(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def _identity_error(fit: DataFrame, d: int, axes: np.ndarray, mean: np.ndarray) -> float:
    """How far the whitened rows' covariance is from the identity, measured on them."""
    k = axes.shape[1]

    def multiply(batches):
        n, first, second = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = (_unpacked(batch.column(0), d) - mean) @ axes
            n, first, second = n + len(w), first + w.sum(axis=0), second + w.T @ w
        yield pa.record_batch([pa.array([n]), pa.array([first.tolist()]), pa.array([second.ravel().tolist()])], ["n", "a", "b"])

    parts = fit.select("x").mapInArrow(multiply, "n long, a array<double>, b array<double>")
    sums = parts.agg(
        F.sum("n"), F.array(*[F.sum(F.col("a")[i]) for i in range(k)]),
        F.array(*[F.sum(F.col("b")[i]) for i in range(k * k)])).first()
    first = np.array(sums[1]) / sums[0]
    second = np.array(sums[2]).reshape(k, k) / sums[0] - np.outer(first, first)
    return float(np.abs(second - np.eye(k)).max())


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = 4) -> Whitening | None:
    """Mean and axes of the distinct vectors; None where there is no vector.

    Vectors that are null or empty, or hold a null or an entry that is not finite (or whose whole
    number doesn't fit a long), are left out. Where lengths differ, those of the length that most
    distinct vectors have count, the greater of two. Each distinct vector counts once, however often it
    repeats. Components whose variance is nought are left out, so one vector gives none.
    """
    every = cut(_packed(vectors, column).distinct())
    length = every.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return None
    d = length["d"]
    fit = every.where(F.col("d") == d)
    n, sums = _sums(fit, d)
    # Centred by whole numbers, which loses nothing; the rest of the mean is taken off exactly.
    centre = [round(Fraction(s, n)) for s in sums]
    products = _products(fit, d, np.array(centre, dtype=np.int64))
    left = [s - n * c for s, c in zip(sums, centre)]
    covariance = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            covariance[i, j] = covariance[j, i] = (int(products[i, j]) * n - left[i] * left[j]) / (n * n)
    values, columns = largest(covariance, components)
    made = Whitening(n, tuple(sums), values, columns, values / max(np.trace(covariance), np.finfo(float).tiny), 0.0)
    error = _identity_error(fit, d, made.axes, made.mean) if len(values) else 0.0
    return Whitening(n, made.sums, values, columns, made.explained, error)


def whiten(vectors: DataFrame, fitted: Whitening | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, deviation, whitened`` for each usable vector: its coordinates on the components.

    ``deviation`` is the sum over dimensions of (n x - S) ** 2, exact; null beyond a long. Rows left
    out of the fit, or of another length, are left out here too. Repeated rows and null keys stay.
    Other columns, whatever their names, are not read; an empty table gives no rows.
    """
    schema = T.StructType([
        T.StructField(key, vectors.schema[key].dataType), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, d, axes, mean = fitted.n, len(fitted.sums), fitted.axes, fitted.mean
    sums, most = np.array(fitted.sums, dtype=object), max(map(abs, fitted.sums))

    def deviations(x: np.ndarray) -> list[int | None]:
        exact = (n * int(np.abs(x).max()) + most) ** 2 * d < 1 << 63
        off = n * x - sums.astype(np.int64) if exact else n * x.astype(object) - sums
        return [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]

    def project(batches):
        for batch in batches:
            for rows, x in _numbers(batch.column(1)):
                if x.shape[1] != d:
                    continue
                whitened = (x - mean) @ axes
                flat = pa.array(whitened.ravel())
                offsets = pa.array(np.arange(0, whitened.size + 1, max(1, axes.shape[1]), dtype=np.int32)
                                   if axes.shape[1] else np.zeros(len(x) + 1, dtype=np.int32))
                yield pa.record_batch([
                    batch.column(0).take(pa.array(rows)), pa.array(deviations(x), pa.int64()),
                    pa.ListArray.from_arrays(offsets, flat)], [key, "deviation", "whitened"])

    return vectors.select(key, F.col(column).cast("array<double>").alias("v")).mapInArrow(project, schema)


def digest(whitened: DataFrame, fitted: Whitening | None, key: str = "vec_id") -> DataFrame:
    """One row per vector and component, from 1."""
    explained = F.array(*[F.lit(float(e)) for e in fitted.explained] if fitted else []).cast("array<double>")
    return whitened.select(key, "deviation", F.posexplode("whitened").alias("at", "value")).select(
        key, (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n if fitted else 0).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), explained[F.col("at")].alias("explained"),
        F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))
