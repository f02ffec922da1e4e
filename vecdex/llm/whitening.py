"""Embedding whitening by a bidiagonal qd solver.

1. Vectors become whole numbers ``floor(64 c) + 1000000``; their number and sums
   per dimension are added up exactly.
2. Blockwise QR: every task reduces its centred rows to one triangular factor;
   factors are joined in a tree of tasks until one is left. ``R'R / n`` is the
   covariance, which is never formed.
3. On the driver, for one ``dim x dim`` matrix: Householder reflections make R
   bidiagonal, dqds finds its singular values to high relative accuracy, and a
   twisted factorisation of each shifted matrix gives the direction; directions
   of values that lie close together are made orthogonal.
4. Rows are projected and scaled where they lie, and the covariance of what comes
   out is measured over all rows.

What reaches the driver is ``dim`` sums, one factor and the Gram matrix of the
components, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET = 64, 1_000_000
#: rows of a block that one QR step takes in, and factors that one task joins
BLOCK_ROWS, FAN_IN = 4096, 32
_EPS = np.finfo(np.float64).eps
#: values whose relative distance is less are one cluster
CLUSTER = 1e-3


# -- the solver: a dim x dim matrix -------------------------------------------

def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal ``a``, superdiagonal ``b`` and orthogonal ``p`` with
    ``r = u B p'`` for some orthogonal ``u``, by Householder reflections."""
    m, n = r.copy(), r.shape[1]
    p = np.eye(n)
    for k in range(n):
        v = _reflector(m[k:, k])
        m[k:, k:] -= np.outer(v, v @ m[k:, k:])
        if k + 2 < n:
            v = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ v, v)
            p[:, k + 1:] -= np.outer(p[:, k + 1:] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), p


def _reflector(x: np.ndarray) -> np.ndarray:
    """``v`` with ``x - v (v'x)`` a multiple of the first unit vector."""
    size = np.linalg.norm(x)
    v = x.copy()
    if size == 0:
        return v
    v[0] += math.copysign(size, v[0])
    return v * (math.sqrt(2) / np.linalg.norm(v))


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, by
    differential quotient-difference steps with shifts."""
    todo = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    found: list[float] = []
    while todo:
        q, e, total = todo.pop()
        while q:
            n = len(q)
            if n == 1 or e[-1] <= (_EPS * _EPS) * (total + q[-1]):
                found.append(total + q.pop())  # the last value stands alone
                e and e.pop()
                continue
            cut = next((k for k in range(n - 1) if e[k] <= (_EPS * _EPS) * (total + q[k])), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], total))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[-1] > 1.5 * q[0]:  # small values belong at the end
                q.reverse(), e.reverse()
            for shift in (_corner(q, e), _below(q, e), 0.0):
                step = _qd_step(q, e, shift)
                if step:
                    q, e, total = *step, total + shift
                    break
    return np.array(sorted(found, reverse=True))


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transformation; none if the shift exceeds the smallest value."""
    d = q[0] - shift
    new_q, new_e = [], []
    for k, low in enumerate(e):
        if d < 0:
            return None
        new_q.append(d + low)
        ratio = q[k + 1] / new_q[-1] if new_q[-1] else 0.0
        new_e.append(low * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def _corner(q: list[float], e: list[float]) -> float:
    """The smaller value of the last two rows; mostly a little too large at first,
    and exact enough near the end."""
    x, y, z = q[-2], e[-1], q[-1]
    half = (x + y + z) / 2
    product = x * z
    root = math.sqrt(max(half * half - product, 0.0))
    return product / (half + root) * (1 - 4 * _EPS) if half + root else 0.0


def _below(q: list[float], e: list[float]) -> float:
    """A bound not above the smallest value: 1 over the trace of the inverse, which
    is the sum of the squared rows of the inverse bidiagonal matrix."""
    if min(q) <= 0:
        return 0.0
    trace = 0.0
    inverse = 0.0
    for k in range(len(q) - 1, -1, -1):
        inverse = (1 + e[k] * inverse) / q[k] if k < len(e) else 1 / q[k]
        trace += inverse
    return (1 - 8 * _EPS * len(q)) / trace


def direction(a: np.ndarray, b: np.ndarray, value: float, against: list[np.ndarray]) -> np.ndarray:
    """A unit eigenvector of ``B'B`` for an eigenvalue, from the twisted
    factorisation of ``B'B - value``; orthogonal to the vectors ``against``."""
    d, low = a * a, b / a[:-1]
    n = len(a)
    plus, lower = np.empty(n), np.empty(n - 1)      # L D L' - value = L+ D+ L+'
    s = np.empty(n)
    s[0] = -value
    for k in range(n - 1):
        plus[k] = _nonzero(s[k] + d[k], value)
        lower[k] = d[k] * low[k] / plus[k]
        s[k + 1] = lower[k] * low[k] * s[k] - value
    minus, upper, p = np.empty(n), np.empty(n - 1), np.empty(n)      # = U- D- U-'
    p[n - 1] = d[n - 1] - value
    for k in range(n - 2, -1, -1):
        minus[k + 1] = _nonzero(d[k] * low[k] ** 2 + p[k + 1], value)
        ratio = d[k] / minus[k + 1]
        upper[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - value
    twist = np.abs(s + p + value)
    for r in np.argsort(twist, kind="stable"):
        z = np.zeros(n)
        z[r] = 1.0
        for k in range(r - 1, -1, -1):
            z[k] = -lower[k] * z[k + 1]
        for k in range(r, n - 1):
            z[k + 1] = -upper[k] * z[k]
        z /= np.linalg.norm(z)
        if not against:
            return z
        for _ in range(2):
            for other in against:
                z -= (other @ z) * other
        if np.linalg.norm(z) > 0.1:  # else the twist gave a vector that is there already
            return z / np.linalg.norm(z)
    raise ArithmeticError("no independent direction")


def _nonzero(x: float, size: float) -> float:
    return x if x else _EPS * size


def directions(r: np.ndarray, n: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of ``r'r / n`` that are not zero, falling,
    and their unit eigenvectors as columns."""
    a, b, p = bidiagonalised(r)
    size = np.abs(a).max(initial=0) + np.abs(b).max(initial=0)
    if size == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    # an exact zero on the diagonal would make the factors infinite
    a = np.where(np.abs(a) < 1e-20 * size, 1e-20 * size, a)
    values = squared_singular_values(a, b)
    kept = values[:wanted]
    kept = kept[kept > (len(a) * _EPS) ** 2 * values[0] * max(r.shape)]
    vectors: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    for k, value in enumerate(kept):
        if k and kept[k - 1] - value > CLUSTER * kept[k - 1]:
            cluster = []
        cluster.append(direction(a, b, value, cluster))
        vectors.append(cluster[-1])
    return kept / n, p @ np.array(vectors).T


# -- the Spark side -------------------------------------------------------------

def usable(vector: str) -> F.Column:
    """Vectors without null or non-finite entries."""
    fine = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")), F.lit(False)))
    return F.coalesce(fine, F.lit(False))


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """``floor(64 c)`` of a batch of vectors; the offset cancels wherever rows are centred."""
    wrong = set(vectors.value_lengths().to_pylist()) - {dim}
    if wrong:
        raise ValueError(f"vectors of width {sorted(wrong)} among those of width {dim}")
    c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(c * SCALE).astype(np.int64).reshape(-1, dim)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            part = whole.slice(at, BLOCK_ROWS)
            yield part, _matrix(part.column(part.num_columns - 1), dim)


def totals(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sums of ``floor(64 c)`` per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dim, np.int64)
        for _, x in _blocks(batches, dim):
            n, sums = n + len(x), sums + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums], pa.list_(pa.int64()))], ["n", "sums"])

    parts = rows.mapInArrow(run, "n long, sums array<long>")
    found = parts.select("n", F.posexplode("sums").alias("at", "sum")).groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect()
    own = {r["at"]: r for r in found}
    return (own[0]["n"] if own else 0), [own[k]["sum"] if own else 0 for k in range(dim)]


def triangular_factor(rows: DataFrame, dim: int, mean: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows, joined in a tree of tasks."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dim))
        for _, x in _blocks(batches, dim):
            r = np.linalg.qr(np.vstack([r, x - mean]), mode="r")
        yield from _factor(r)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dim))
        for batch in batches:
            for flat in batch.column(0):
                r = np.linalg.qr(np.vstack([r, flat.values.to_numpy(zero_copy_only=False).reshape(-1, dim)]), mode="r")
        yield from _factor(r)

    parts = rows.rdd.getNumPartitions()
    tree = rows.mapInArrow(reduce, "r array<double>")
    while parts > 1:
        parts = -(-parts // FAN_IN)
        tree = tree.repartition(parts).mapInArrow(join, "r array<double>")
    found = [np.array(row["r"]).reshape(-1, dim) for row in tree.collect()]
    return np.linalg.qr(np.vstack([np.zeros((dim, dim)), *found]), mode="r")


def _factor(r: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(r):
        yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["r"])


def identity_error(rows: DataFrame, dim: int, mean: np.ndarray, weights: np.ndarray, n: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity,
    measured over all rows."""
    k = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, gram = np.zeros(k), np.zeros((k, k))
        for _, x in _blocks(batches, dim):
            y = (x - mean) @ weights
            sums, gram = sums + y.sum(axis=0), gram + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([sums, gram.ravel()])], pa.list_(pa.float64()))], ["s"])

    found = rows.mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(k + k * k)
    for r in found:
        flat[r["at"]] = r["s"]
    centre = flat[:k] / n
    return float(np.abs(flat[k:].reshape(k, k) / n - np.outer(centre, centre) - np.eye(k)).max(initial=0))


def whitened(vectors: DataFrame, dim: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
             components: int = 32) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: a
    row for each usable vector and each of the first ``components`` components.

    Rows whose vector is null or holds null or non-finite entries are dropped;
    vectors of several widths raise. ``dim`` is read from one vector if not given.
    Repeated rows, ties and null ids are rows like any other. Components without
    variance cannot be scaled and are left out, so one vector alone, equal vectors
    and an empty table give no rows. ``deviation`` is an exact decimal. Columns
    besides the two named ones are not read, so their names cannot clash."""
    kind = vectors.schema[id_col].dataType
    rows = vectors.where(usable(vector_col)).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("y", T.ArrayType(T.DoubleType()))])
    only = rows.select("v")
    if dim is None:
        one = only.select(F.size("v")).first()
        dim = one[0] if one else 0
    n, sums = totals(only, dim) if dim else (0, [])
    mean = np.array([s / n for s in sums]) if n else np.zeros(dim)
    spread, weights, error = np.zeros(0), np.zeros((dim, 0)), 0.0
    trace = 1.0
    if n:
        r = triangular_factor(only, dim, mean)
        trace = float((r * r).sum() / n)
        spread, axes = directions(r, n, components)
        weights = axes / np.sqrt(spread)
        error = identity_error(only, dim, mean, weights, n)
    whole = np.array(sums, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, dim):
            away = (n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)) ** 2 * max(dim, 1)
            apart = n * (x if away < 2 ** 62 else x.astype(object)) - (whole.astype(np.int64) if away < 2 ** 62 else whole)
            squared = (apart * apart).sum(axis=1)
            y = (x - mean) @ weights
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * y.shape[1])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([int(v) for v in squared], pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], schema.names)

    share = F.array(*[F.lit(float(e / trace)) for e in spread]) if len(spread) else F.array().cast("array<double>")
    out = rows.mapInArrow(run, schema).select(id_col, "deviation", F.posexplode("y").alias("at", "whitened"))
    return out.select(id_col, (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
