"""Whitening of embeddings by their leading principal components.

Sums and the centred covariance are gathered in the tasks over all vectors
(centred before multiplying) and added up on Spark.  The covariance, dimensions
squared however many vectors there are, is reduced on the driver: Householder
reflections make it tridiagonal, bisection with Sturm counts finds the leading
eigenvalues, inverse iteration their vectors, orthogonalised again within
clusters of close eigenvalues.  The components are broadcast and every vector is
projected; the whitened columns' own covariance, gathered the same way, gives
the identity error.

Defined results: rows whose vector is null, empty, or holds a null or
non-finite component are dropped, and so are vectors of another length than
most have (of equally common lengths the longer); components are taken as at
most 2^30 in size.  Eigenvalues that rounding cannot tell from 0 give no
component (so a single vector, or copies of one, give no rows).  Repeated
rows and null or equal ids count and come out each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written
from .vectorcodes import _matrix, usable, whole

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
_BOUND = float(1 << 30)
#: Eigenvalues below this share of the largest are rounding.
RELATIVE_ZERO = 1e-12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit reflectors of a symmetric matrix."""
    a, n, reflectors = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        u = np.zeros_like(x)
        if size and np.abs(x[1:]).max() > 0:
            u[:] = x
            u[0] += np.copysign(size, x[0])
            u /= np.linalg.norm(u)
            block = a[k + 1 :, k + 1 :]
            p = block @ u
            p -= (u @ p) * u
            block -= 2 * (np.outer(u, p) + np.outer(p, u))
            a[k + 1 :, k] = a[k, k + 1 :] = x - 2 * u * (u @ x)
        reflectors.append(u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def sturm_count(d: np.ndarray, e2: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues lie below each of ``x``: the negative pivots."""
    q, below = d[0] - x, np.zeros(len(x), np.int64)
    for i in range(len(d)):
        if i:
            q = d[i] - x - e2[i - 1] / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection to the last bit."""
    n, e2 = len(d), e * e
    reach = np.zeros(n)
    reach[:-1] += np.abs(e)
    reach[1:] += np.abs(e)
    lo, hi = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    size = max(np.abs(lo).max(), np.abs(hi).max(), np.finfo(float).tiny)
    lo, hi, tiny = lo - size * 1e-15, hi + size * 1e-15, size * 1e-300 + np.finfo(float).tiny
    wanted = n - 1 - np.arange(k)
    for _ in range(200):
        mid = (lo + hi) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        above = sturm_count(d, e2, mid, tiny) <= wanted
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return (lo + hi) / 2


def _shifted_solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges."""
    n = len(d)
    main, up, up2, y = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        below, nxt = e[i], main[i + 1]
        after = up[i + 1] if i + 1 < n - 1 else 0.0
        if abs(below) > abs(main[i]):
            f = main[i] / below
            main[i + 1], up[i + 1] = up[i] - f * nxt, -f * after
            main[i], up[i], up2[i] = below, nxt, after
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
        else:
            main[i] = main[i] if abs(main[i]) > tiny else tiny
            f = below / main[i]
            main[i + 1] = nxt - f * up[i]
            y[i + 1] -= f * y[i]
    main[-1] = main[-1] if abs(main[-1]) > tiny else tiny
    out = np.zeros(n)
    for i in range(n - 1, -1, -1):
        s = y[i]
        if i + 1 < n:
            s -= up[i] * out[i + 1]
        if i + 2 < n:
            s -= up2[i] * out[i + 2]
        out[i] = s / main[i]
        if abs(out[i]) > 1e200:  # only the direction counts
            out /= abs(out[i])
            y = y / abs(s / main[i])
    return out


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (rows) of the tridiagonal matrix for ``values`` (falling).
    Those closer than 1e-3 of the norm to the one before form a cluster, whose
    vectors are made orthogonal in every step."""
    n = len(d)
    norm = max(np.abs(d).max() + 2 * (np.abs(e).max() if len(e) else 0.0), np.finfo(float).tiny)
    rng, out, first = np.random.default_rng(13), [], 0
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        # Equal eigenvalues are told apart by the least shift.
        shift = value if k == first else min(value, shift - 4 * np.finfo(float).eps * norm)
        y = rng.standard_normal(n)
        y /= np.linalg.norm(y)
        for _ in range(6):
            z = _shifted_solve(d, e, shift, y, np.finfo(float).eps * norm)
            z /= np.linalg.norm(z)
            for _ in range(2):
                for other in out[first:k]:
                    z -= (other @ z) * other
                z /= np.linalg.norm(z)
            y = z
        out.append(y)
    return np.array(out).reshape(len(values), n)


def principal(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors (rows)."""
    n, size = len(cov), np.abs(cov).max()
    if n == 1 or not size:
        return np.diag(cov)[:k].copy(), np.eye(min(k, n), n)
    d, e, reflectors = tridiagonal(cov / size)
    values = leading_eigenvalues(d, e, min(k, n))
    vectors = eigenvectors(d, e, values)
    for j in range(len(reflectors) - 1, -1, -1):
        u = reflectors[j]
        vectors[:, j + 1 :] -= 2 * np.outer(vectors[:, j + 1 :] @ u, u)
    return values * size, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix_sum(rows: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all batches of the matrix ``of(x)`` (any x ``width``), added up
    in each task, then by matrix row."""

    def task(batches):
        held = None
        for batch in batches:
            if batch.num_rows:
                m = of(_matrix(batch.column(0), width, np.int64))
                held = m if held is None else held + m
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held.tolist(), pa.list_(pa.float64()))], names=["i", "m"])

    parts = rows.select("x").mapInArrow(task, "i int, m array<double>")
    total = parts.select("i", F.posexplode("m").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((1 + max((r["i"] for r in total), default=-1), 1 + max((r["j"] for r in total), default=-1)))
    for r in total:
        out[r["i"], r["j"]] = r["v"]
    return out


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable vector and component: ``id``, ``component`` (from 1),
    ``n``, ``deviation`` (decimal: the sum over dimensions of (n x - S)^2; null
    from 10^38),
    ``whitened``, ``explained``, ``identity_error``."""
    kept = usable(vectors, vector_col)
    rows = written(kept.select(kept[id_col].alias("id"), F.transform(kept[vector_col], lambda c: whole(c, scale, _BOUND) + shift).alias("x")), "whole-vectors")
    sums = rows.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("j").collect()
    schema = T.StructType([rows.schema["id"], *(T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)), ("whitened", T.DoubleType()), ("explained", T.DoubleType())))])
    total, n, width = [int(r["s"]) for r in sums], sums[0]["n"] if sums else 0, len(sums)
    if not n:
        return rows.sparkSession.createDataFrame([], schema).withColumn("identity_error", F.lit(0.0))
    # The mean as a whole and a small part, so that centring loses nothing.
    base = np.array([s // n for s in total], np.int64)
    rest = np.array([(s % n) / n for s in total])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base).astype(np.float64) - rest

    def outer(x: np.ndarray) -> np.ndarray:
        z = centred(x)
        return z.T @ z

    cov = _matrix_sum(rows, width, outer) / n
    trace = float(np.trace(cov))
    values, axes = principal((cov + cov.T) / 2, components)
    fits = values > RELATIVE_ZERO * max(trace, np.finfo(float).tiny)
    values, axes = values[fits], axes[fits]
    project = (axes / np.sqrt(values)[:, None]).T

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ project
        return np.vstack([w.T @ w, w.sum(0)])

    error = 0.0
    if len(values):
        m = _matrix_sum(rows, width, moments) / n
        error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(len(values))).max())
    remainder = np.array([s % n for s in total], np.int64)

    def task(batches):
        k = len(values)
        for batch in batches:
            x = _matrix(batch.column(1), width, np.int64)
            if not len(x) or not k:
                continue
            away = x - base
            if width * (n * (int(np.abs(away).max()) + 1)) ** 2 < 1 << 63:
                far = ((away * n - remainder) ** 2).sum(1).tolist()
            else:
                far = [sum((n * v - s) ** 2 for v, s in zip(row, total, strict=True)) for row in x.tolist()]
            deviation = [decimal.Decimal(v) if v < 10**38 else None for v in far]
            w = centred(x) @ project
            each = np.repeat(np.arange(len(x)), k)
            out = [
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n)),
                pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(values / trace, len(x))),
            ]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(task, schema).withColumn("identity_error", F.lit(error))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whiten(table(spark, sf_dir, "embeddings"))
    return done.withColumn("deviation", F.col("deviation").try_cast("bigint")).withColumnRenamed("id", "vec_id")
