"""Embedding whitening (operator 13).

Vectors are whitened by the leading components of their covariance: centred,
projected on the unit eigenvectors of the largest eigenvalues, and divided by
the square root of the eigenvalue, so that the results are uncorrelated and of
variance one.

1. Every task folds its vectors into a count, exact integer sums and a centred
   sum of products: batches are centred on their own mean before they are
   multiplied and merged by the pairwise rule.  Partial results (d squared
   numbers, whatever the number of rows) meet in two steps, so no task reads
   more than about the square root of their number.
2. The covariance is reduced to a tridiagonal matrix by Householder
   reflections.  The leading eigenvalues are found by bisection on Sturm
   counts, the vectors by inverse iteration; vectors of eigenvalues that lie
   close together are made orthogonal to each other.  This runs in one task
   per vector length.
3. Mean and components (at most ``k`` + 2 rows of d numbers) are sent to all
   tasks, which project their vectors.  Models of many lengths are sent in
   portions of at most ``MODEL_BYTES``.
4. The covariance of the whitened vectors is computed as in 1, to report how
   far it is from the identity.

Entries are put on an integer grid first, ``floor(scale * c) + shift``, so that
the sums are exact.

Defined results: a vector that is NULL or holds a NULL or non-finite entry is
dropped; vectors of each length are fitted by themselves; an entry whose grid
value is beyond 2^52 is set to that bound; an empty vector has no component
and a whitened array of none; a vector shorter than ``k`` has as many
components as entries; a component of which the variance is zero within
rounding has a NULL in the whitened array; a deviation too large for a bigint
is NULL; repeated rows count as often as they occur; an empty table gives an
empty result; other columns pass through, those named like an added one give
way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import cut, quoted
from strata.session import scratch_dir, ship_package

#: Grid of the entries: so many steps to one, and what is added.
SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 52
COMPONENTS = 8
#: Bytes of models that tasks hold at a time; models beyond it are used in further passes.
MODEL_BYTES = 32 << 20
#: Rows of one length that a task turns into a matrix at a time.
ROWS = 4096
MADE = ("whitened", "deviation", "fit_rows", "explained", "identity_error")


# ---- eigenvalues of a symmetric matrix ---------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with ``a = q t q'``, by Householder reflections."""
    a = np.array(a, np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        if not np.any(v[1:]):
            continue
        left = -math.copysign(np.linalg.norm(v), v[0])
        v[0] -= left
        v /= np.linalg.norm(v)
        # a <- h a h with h = 1 - 2 v v', as one symmetric update of rank two.
        p = a[k + 1:, k + 1:] @ v
        w = p - (v @ p) * v
        a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = 0.0
        a[k + 1, k] = a[k, k + 1] = left
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_counts(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``at`` the number of eigenvalues below it: negative pivots of ``t - at``."""
    tiny = np.finfo(np.float64).tiny / np.finfo(np.float64).eps
    e2 = np.concatenate([[0.0], e * e])
    count = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i in range(len(d)):
        pivot = d[i] - at - e2[i] / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of the tridiagonal matrix, falling, by bisection."""
    n = len(d)
    side = np.concatenate([[0.0], np.abs(e)]) + np.concatenate([np.abs(e), [0.0]])
    span = max(np.max(np.abs(d) + side), np.finfo(np.float64).tiny)
    low, high = np.full(k, np.min(d - side) - span * 1e-12), np.full(k, np.max(d + side) + span * 1e-12)
    rank = n - np.arange(k)  # the i-th largest has fewer than n - i eigenvalues below it
    for _ in range(128):
        mid = (low + high) / 2
        if np.all((mid <= low) | (mid >= high)):
            break
        below = sturm_counts(d, e, mid) < rank
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, small: float) -> np.ndarray:
    """Solve ``(t - shift) x = b`` by elimination with row exchanges; zero pivots become ``small``."""
    n = len(d)
    diag, upper, second = d - shift, np.append(e, 0.0), np.zeros(n)
    x = b.copy()
    for i in range(n - 1):
        under = e[i]
        if abs(under) > abs(diag[i]):
            diag[i], upper[i], second[i], d1, u1 = under, diag[i + 1], upper[i + 1], diag[i], upper[i]
            x[i], x[i + 1] = x[i + 1], x[i]
            f = d1 / diag[i]
            diag[i + 1], upper[i + 1] = u1 - f * upper[i], -f * second[i]
        else:
            if diag[i] == 0:
                diag[i] = small
            f = under / diag[i]
            diag[i + 1] -= f * upper[i]
        x[i + 1] -= f * x[i]
    if diag[-1] == 0:
        diag[-1] = small
    x[-1] /= diag[-1]
    if n > 1:
        x[-2] = (x[-2] - upper[-2] * x[-1]) / diag[-2]
    for i in range(n - 3, -1, -1):
        x[i] = (x[i] - upper[i] * x[i + 1] - second[i] * x[i + 2]) / diag[i]
    return x


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, seed: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) for the falling ``values``, by inverse iteration.

    Values within a thousandth of the matrix's norm of the one before form a
    cluster, in which every iterate is made orthogonal to the earlier vectors.
    """
    n, eps = len(d), np.finfo(np.float64).eps
    norm = max(np.max(np.abs(d)), np.max(np.abs(e), initial=0.0), np.finfo(np.float64).tiny)
    rng = np.random.default_rng(seed)
    out = np.zeros((n, len(values)))
    first, used = 0, math.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # Equal values are kept a little apart, as equal shifts would find one vector twice.
        used = min(value, used - 2 * eps * norm) if j > first else value
        x = rng.normal(size=n)
        x /= np.linalg.norm(x)
        for step in range(12):
            size = np.max(np.abs(x))
            x = _solve(d, e, used, x / size if size else rng.normal(size=n), eps * norm)
            x /= np.max(np.abs(x))
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            length = np.linalg.norm(x)
            if length < 1e-8:  # nothing left but rounding: start from another vector
                x = rng.normal(size=n)
                continue
            x /= length
            residual = d * x - value * x
            residual[:-1] += e * x[1:]
            residual[1:] += e * x[:-1]
            if step >= 2 and np.linalg.norm(residual) <= 8 * n * eps * norm:
                break
        out[:, j] = x
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of the symmetric ``v``, falling, and their unit vectors as rows."""
    k = min(k, len(v))
    if not k:
        return np.zeros(0), np.zeros((0, len(v)))
    size = np.max(np.abs(v))
    if size == 0:
        return np.zeros(k), np.eye(len(v))[:k]
    d, e, q = tridiagonal(v / size)
    values = leading_eigenvalues(d, e, k)
    vectors = q @ tridiagonal_vectors(d, e, values)
    for j in range(k):  # across clusters too, to the last bit
        vectors[:, j] -= vectors[:, :j] @ (vectors[:, :j].T @ vectors[:, j])
        vectors[:, j] /= np.linalg.norm(vectors[:, j])
    return values * size, vectors.T.copy()


# ---- moments over partitions ----------------------------------------------------------

@dataclass
class Moments:
    """Rows, exact sums and the centred sum of products of vectors of one length."""

    n: int
    sums: list[int] | list[float]
    products: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], np.float64)

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        exact = x.dtype.kind == "i"
        sums = [sum(c) for c in x.T.tolist()] if exact and float(np.abs(x).max(initial=0)) * len(x) >= 2.0**62 else x.sum(0).tolist()
        out = cls(len(x), sums, np.zeros((x.shape[1], x.shape[1])))
        y = x - out.mean
        out.products = y.T @ y
        return out

    def merged(self, other: Moments) -> Moments:
        apart = other.mean - self.mean
        n = self.n + other.n
        return Moments(n, [a + b for a, b in zip(self.sums, other.sums)],
                       self.products + other.products + np.outer(apart, apart) * (self.n / n * other.n))


_MOMENTS = "dim int, part int, n bigint, sums array<string>, products binary"
_MOMENTS_ARROW = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("products", pa.binary())])


def names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def _pack(dim: int, part: int, m: Moments) -> tuple:
    return dim, part, m.n, [repr(s) for s in m.sums], m.products.tobytes()  # repr: integers of any size, doubles exactly


def _unpack(row, exact: bool) -> Moments:
    kind = int if exact else float
    return Moments(int(row.n), [kind(s) for s in row.sums], np.frombuffer(row.products, np.float64).reshape(len(row.sums), len(row.sums)))


def _fold(rows: pd.DataFrame, exact: bool) -> Moments:
    total = None
    for row in rows.itertuples():
        m = _unpack(row, exact)
        total = m if total is None else total.merged(m)
    return total


def moments(rows: DataFrame, matrices, exact: bool, name: str) -> DataFrame:
    """One row of moments per vector length; ``matrices`` gives (length, matrix) of a batch of ``rows``.

    ``exact``: the matrices hold integers.  All matrices of a length are of one width.
    """
    ship_package(rows.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: dict[int, Moments] = {}
        for batch in batches:
            for dim, x in matrices(batch):
                m = Moments.of(x)
                held[dim] = held[dim].merged(m) if dim in held else m
        if held:
            rows = [_pack(dim, part, m) for dim, m in held.items()]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=names(_MOMENTS)), schema=_MOMENTS_ARROW, preserve_index=False)

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_pack(int(rows["dim"].iat[0]), 0, _fold(rows, exact))], columns=names(_MOMENTS))

    parts = cut(rows.mapInArrow(partial, _MOMENTS), name)
    # About as many groups as each of them has rows.
    groups = max(1, math.isqrt(parts.count()))
    some = parts.groupBy("dim", F.pmod("part", F.lit(groups))).applyInPandas(fold, _MOMENTS)
    return some.groupBy("dim").applyInPandas(fold, _MOMENTS)


# ---- the operator -----------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def _grid(batch: pa.RecordBatch, column: str, scale: int, shift: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, grid values) of the vectors of a batch, ``ROWS`` at a time."""
    vectors = batch.column(column)
    dims = np.diff(vectors.offsets.to_numpy())
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = vectors.offsets.to_numpy()[:-1]
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        for a in range(0, len(at), ROWS):
            rows = at[a : a + ROWS]
            x = np.floor(values[starts[rows][:, None] + np.arange(dim)] * scale)
            yield dim, rows, np.clip(x, -LARGEST, LARGEST).astype(np.int64) + shift


@dataclass
class Model:
    """What a vector of one length is projected with."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        floor = self.vectors.shape[1] * np.finfo(np.float64).eps * self.values.max(initial=0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (x - mean) @ self.vectors.T / np.sqrt(self.values)
        out[:, self.values <= floor] = np.nan
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """For each row the sum of (n x - sums)^2, exactly; None where a bigint cannot hold it."""
        if not x.shape[1]:
            return [0] * len(x)
        mean = np.array([s / self.n for s in self.sums])
        about = ((x - mean) ** 2).sum(1) * float(self.n) ** 2
        fits = about < 2.0**63 * (1 + 1e-6)
        if max(self.n * int(np.abs(x).max(initial=0)), *map(abs, self.sums)) < 2**62:
            z = self.n * x - np.array(self.sums, np.int64)
            if np.abs(z).max(initial=0) < 2**31 and (about < 2.0**62).all():
                return (z * z).sum(1).tolist()
            exact = [sum(c * c for c in r) if ok else None for r, ok in zip(z.tolist(), fits)]
        else:
            exact = [sum((self.n * c - s) ** 2 for c, s in zip(r, self.sums)) if ok else None for r, ok in zip(x.tolist(), fits)]
        return [v if v is not None and v < 2**63 else None for v in exact]


_MODEL = "dim int, n bigint, sums array<string>, eigenvalues array<double>, vectors binary, trace double"


def fit(rows: DataFrame, vector: str, k: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per vector length: rows, sums, eigenvalues, unit vectors (rows of doubles) and the covariance's trace."""
    found = moments(rows.select(vector), lambda batch: ((dim, x) for dim, _, x in _grid(batch, vector, scale, shift)), True, "moments")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.itertuples():
            m = _unpack(row, True)
            v = m.products / m.n
            values, vectors = leading_components((v + v.T) / 2, k)
            out.append((row.dim, m.n, row.sums, values.tolist(), vectors.tobytes(), float(np.trace(v))))
        return pd.DataFrame(out, columns=names(_MODEL))
    return cut(found.groupBy("dim").applyInPandas(solve, _MODEL), "whitening-models")


def _portions(models: DataFrame) -> Iterator[dict[int, Model]]:
    """Models as dictionaries by length, each portion of at most about ``MODEL_BYTES``."""
    held, size = {}, 0
    for r in models.toLocalIterator():
        held[r.dim] = Model(r.n, [int(s) for s in r.sums], np.array(r.eigenvalues, np.float64),
                            np.frombuffer(r.vectors, np.float64).reshape(len(r.eigenvalues), r.dim), r.trace)
        size += 8 * r.dim * (len(r.eigenvalues) + 2) + 256
        if size >= MODEL_BYTES:
            yield held
            held, size = {}, 0
    if held:
        yield held


def whiten(rows: DataFrame, vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Usable ``rows`` without the vector, plus for each the arrays ``whitened`` and ``explained`` (share of the
    variance) by component, ``deviation``, ``fit_rows`` (vectors in the fit) and ``identity_error`` of the fit."""
    ship_package(rows.sparkSession)
    others = [c for c in rows.columns if c != vector and c.lower() not in MADE]
    good = rows.filter(usable(F.col(f"`{vector}`"))).select(
        F.struct(*quoted(others)).alias("rest") if others else F.lit(None).cast("int").alias("rest"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    models = fit(good, "vector", k, scale, shift)
    made = T.StructType([good.schema["rest"], *T.StructType.fromDDL("dim int, whitened array<double>, deviation bigint")])
    path = scratch_dir(rows.sparkSession, "whitened")

    def project(known: dict[int, Model]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, at, x in _grid(batch, "vector", scale, shift):
                    y = known[dim].project(x)
                    flat = pa.array(y.ravel(), mask=np.isnan(y).ravel())
                    arrays = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * y.shape[1], flat)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("rest").take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)), arrays,
                        pa.array(known[dim].deviations(x), pa.int64())], made.names)
        return run

    spark = rows.sparkSession
    spark.createDataFrame([], made).write.parquet(path)
    lengths = 0
    for known in _portions(models):
        lengths += len(known)
        these = good.filter(F.size("vector").isin([int(d) for d in known]))
        these.mapInArrow(project(known), made).write.mode("append").parquet(path)
    out = spark.read.schema(made).parquet(path)

    def defined(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """Whitened vectors by length, without the components that have no variance (in all rows the same last ones)."""
        dims, rows = batch.column("dim").to_numpy(), batch.column("whitened").to_pylist()
        for dim in np.unique(dims).tolist():
            some = [[c for c in rows[i] if c is not None] for i in np.flatnonzero(dims == dim)]
            if some[0]:
                yield dim, np.array(some, np.float64)

    def error(rows: pd.DataFrame) -> pd.DataFrame:
        m = _fold(rows, False)
        return pd.DataFrame({"dim": rows["dim"], "identity_error": np.abs(m.products / m.n - np.eye(len(m.products))).max()})

    errors = (moments(out.select("dim", "whitened"), defined, False, "whitened-moments")
              .groupBy("dim").applyInPandas(error, "dim int, identity_error double"))
    facts = models.select("dim", F.col("n").alias("fit_rows"), F.transform(
        "eigenvalues", lambda e: F.try_divide(F.greatest(e, F.lit(0.0)), F.col("trace"))).alias("explained"))
    facts = cut(facts.join(errors, "dim", "left"), "whitening-facts")
    if lengths * (8 * k + 64) <= MODEL_BYTES:  # a row per vector length
        facts = F.broadcast(facts)
    return out.join(facts, "dim").select(*(["rest.*"] if others else []), "whitened", "deviation", "fit_rows", "explained", "identity_error")
