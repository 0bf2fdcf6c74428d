"""Embedding whitening: exact integer covariance over all tasks, eigenvectors of float32 refined in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import frugal

# An entry c is worked on as floor(64 * c) + 1000000.
SCALE, SHIFT = 64, 1_000_000

_EXACT = 1 << 53  # integers that a double holds
_WIDE = T.DecimalType(38, 0)
_ROUNDS = 60


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, x): vectors as longs.  Those that are null or empty, or hold null or non-finite entries, are left out;
    entries beyond the longs are taken as the largest ones."""
    v = F.col(vector_column).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.select(F.col(id_column).alias("id"), v.alias("v")).filter(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0))
    most = float(1 << 62)
    return kept.select("id", F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(most)), F.lit(-most))) + SHIFT).alias("x"))


@dataclass(frozen=True)
class Fit:
    """Sums over the fit list: ``n`` vectors, per dimension the sum S = n * base + rest with 0 <= rest < n, and the exact
    sums of products of (x - base).  ``reach`` is the largest |x - base|."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    reach: int
    products: np.ndarray

    @property
    def covariance(self) -> np.ndarray:
        """n * sum(y y') - r r' over n * n, every entry rounded once, in the widest float of numpy."""
        r = self.rest.astype(object)
        whole = self.n * self.products - np.outer(r, r)
        return np.array([[_wide(Fraction(int(v), self.n * self.n)) for v in row] for row in whole])

    @property
    def mean_rest(self) -> np.ndarray:
        return np.array([float(Fraction(int(r), self.n)) for r in self.rest])


def _wide(f: Fraction) -> np.longdouble:
    high = float(f)
    return np.longdouble(high) + np.longdouble(float(f - Fraction(high)))


def _rows(batch: pa.RecordBatch, base: np.ndarray, reach: int) -> np.ndarray:
    """x - base as int64, or as Python integers where these would not do."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(base))
    return x - base if reach < 1 << 31 else x.astype(object) - base.astype(object)


def fit(x: DataFrame) -> Fit | None:
    """Two aggregates over all vectors: sums and ranges, then products of what is left after centring.

    Each task adds its own rows up and hands over one matrix, so that the shuffle is tasks times dimensions squared and
    the driver gets one matrix; nothing depends on how rows are split, as all sums are of integers.
    None without vectors; vectors of different lengths raise.
    """
    sizes = x.agg(F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi"), F.count("*").alias("n")).first()
    if not sizes["n"]:
        return None
    if sizes["lo"] != sizes["hi"]:
        raise ValueError(f"vectors of {sizes['lo']} to {sizes['hi']} entries")
    dim, n = sizes["lo"], sizes["n"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low, high = np.zeros(dim, object), None, None
        for batch in batches:
            if batch.num_rows:
                a = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                total = total + (a >> 31).sum(0).astype(object) * (1 << 31) + (a & ((1 << 31) - 1)).sum(0)
                low = a.min(0) if low is None else np.minimum(low, a.min(0))
                high = a.max(0) if high is None else np.maximum(high, a.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim, dtype=np.int32)), _decimals(total), pa.array(low), pa.array(high)], ["j", "s", "lo", "hi"]
            )

    per = x.select("x").mapInArrow(frugal(sums), "j int, s decimal(38,0), lo bigint, hi bigint")
    per = per.groupBy("j").agg(F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("j").collect()
    base = np.array([int(r["s"]) // n for r in per], np.int64)
    rest = np.array([int(r["s"]) % n for r in per], np.int64)
    reach = max(max(r["hi"] - int(b), int(b) - r["lo"]) for r, b in zip(per, base, strict=True))
    i, j = np.triu_indices(dim)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((dim, dim), object), False
        step = max(1, min(8192, _EXACT // max(1, reach * reach)))
        for batch in batches:
            y = _rows(batch, base, reach)
            some = some or len(y) > 0
            for at in range(0, len(y), step):
                part = y[at:at + step]
                if reach * reach < _EXACT:  # sums of a block are exact in doubles
                    part = part.astype(np.float64)
                    total += (part.T @ part).astype(np.int64)
                else:
                    part = part.astype(object)
                    total += part.T.dot(part)
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(total[i, j])], ["i", "j", "s"])

    cells = x.select("x").mapInArrow(frugal(products), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    whole = np.zeros((dim, dim), object)
    for r in cells:
        whole[r["i"], r["j"]] = whole[r["j"], r["i"]] = int(r["s"])
    return Fit(n, base, rest, int(reach), whole)


def _decimals(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


# Eigenvectors

def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of a symmetric matrix, values falling.

    LAPACK in float32 gives the start.  Ogita and Aishima's iteration, matrix products in float64 and then in numpy's
    widest float, squares the error in each round.  Eigenvalues closer than the error of the round form a cluster: within it vectors
    are only made orthogonal, and the cluster's own small matrix, shifted by its mean, is solved apart, which
    separates what float32 could not.  Values that are truly equal leave any orthogonal basis of their space.
    """
    size = np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a.astype(np.longdouble) / size
    x = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, np.longdouble):
        own, x, best = a.astype(kind), x.astype(kind), None
        for _ in range(_ROUNDS):
            x, values, change, delta = _refine(own, x)
            order = np.argsort(-values, kind="stable")
            x, values = x[:, order], values[order]
            for lo, hi in _clusters(values, delta):
                x[:, lo:hi] = _sub_solve(own, x[:, lo:hi])
            if change <= 8 * np.finfo(kind).eps * len(a) or (best is not None and change >= best / 2):
                break
            best = change
    x = x @ (1.5 * np.eye(len(a)) - x.T @ x / 2)
    values = (x * (a @ x)).sum(0) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * size).astype(np.float64), x[:, order].astype(np.float64)


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One round: new vectors, eigenvalues, the largest change of separated vectors, and the width of a cluster."""
    r = np.eye(len(a)) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    delta = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > delta
    e = np.where(apart, (s + r * values[None, :]) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(np.abs(e).max()), float(delta)


def _clusters(values: np.ndarray, delta: float) -> list[tuple[int, int]]:
    """Runs of two or more falling values with gaps of at most delta."""
    cuts = [0, *(np.flatnonzero(values[:-1] - values[1:] > delta) + 1), len(values)]
    return [(lo, hi) for lo, hi in zip(cuts, cuts[1:]) if hi - lo > 1]


def _sub_solve(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rotate a cluster's vectors to the eigenvectors of its own matrix, less its mean eigenvalue."""
    small = x.T @ (a @ x)
    small = (small + small.T) / 2
    small = small - np.eye(len(small)) * (np.trace(small) / len(small))
    size = np.abs(small).max()
    if size == 0:
        return x
    return x @ np.linalg.eigh((small / size).astype(np.float64))[1].astype(x.dtype)


# Whitening

WHITENED = ["n", "deviation", "component", "whitened", "explained", "identity_error"]


def whiten(vectors: DataFrame, components: int = 32, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every vector that takes part and every
    component up to ``components``, numbered from 1 by falling eigenvalue.

    x = floor(64 c) + 1000000.  whitened is x less the mean, projected on the component, over the root of its
    eigenvalue; deviation the exact sum of (n x - S) ** 2 (decimal, null beyond 38 digits); explained the eigenvalue's share of
    the trace; identity_error the largest absolute entry of whitened's covariance less the identity, measured on the
    whitened rows.  Vectors that are null or empty, or hold null or non-finite entries, take no part; vectors of
    different lengths raise.  Repeated rows and null ids count as rows of their own.  A component whose eigenvalue is
    0 up to rounding (constant dimensions, fewer vectors than dimensions) has null whitened values and no part in
    identity_error; explained is null if all vectors are equal.  No vectors give no rows.  Other columns are not carried.

    The driver holds one matrix of dimensions squared; tasks get base, mean and at most ``components`` vectors.
    """
    if id_column.lower() in WHITENED:
        raise ValueError(f"an id column cannot be called {id_column}")
    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType
    schema = T.StructType([
        T.StructField(id_column, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", _WIDE),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    x = integer_vectors(vectors, id_column, vector_column)
    f = fit(x)
    if f is None:
        return spark.createDataFrame([], schema)
    n, dim, base, reach, rest = f.n, len(f.base), f.base, f.reach, f.rest
    values, axes = eigen(f.covariance)
    trace = float(np.trace(f.covariance))
    k = min(components, dim)
    live = values[:k] > dim * np.finfo(np.float64).eps * max(float(values[0]), 0)
    axes = axes[:, :k] / np.sqrt(np.where(live, values[:k], 1))
    axes[:, ~live] = np.nan
    explained = values[:k] / trace if trace > 0 else np.full(k, np.nan)
    mean, m = f.mean_rest, int(live.sum())

    def projected(y: np.ndarray) -> np.ndarray:
        return (y.astype(np.float64) - mean) @ axes

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + 1, m))
        for batch in batches:
            w = projected(_rows(batch, base, reach))[:, live]
            total[:m] += w.T @ w
            total[m] += w.sum(0)
        i, j = np.indices(total.shape, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "s"])

    error = None
    if m:
        got = np.zeros((m + 1, m))
        for r in x.select("x").mapInArrow(frugal(moments), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
            got[r["i"], r["j"]] = r["s"] / n
        error = float(np.abs(got[:m] - np.outer(got[m], got[m]) - np.eye(m)).max())
    narrow = (n * (reach + 1)) ** 2 * dim < 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _rows(batch, base, reach)
            off = y * n - rest if narrow else y.astype(object) * n - rest.astype(object)
            deviation = [v if v < 10**38 else None for v in map(int, (off * off).sum(1))]
            w, rows = projected(y), len(y)
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n)),
                pa.array([None if v is None else Decimal(v) for v in deviation], pa.decimal128(38, 0)).take(pa.array(each)),
                pa.array(w.ravel(), from_pandas=True),
                pa.array(np.tile(explained, rows), from_pandas=True),
                pa.array([error] * (rows * k), pa.float64()),
            ], schema.names)

    return x.mapInArrow(frugal(run), schema)
