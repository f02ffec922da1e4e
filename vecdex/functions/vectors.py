"""Vector math as Column expressions (P9-P13) plus the numpy kernels used by
the Arrow scoring path.

Column helpers accumulate in DOUBLE whatever the element type is. They are
exact and oracle-friendly; the bulk scoring path (operators.topk) uses Arrow
batches + matmul instead because higher-order functions are interpreted row
by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-9
# fixed value: the error text for a vector of the wrong width (+ actual size)
DIM_ERROR = "Embedding service returned unexpected vector dimension: "


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """sum(a[i] * b[i]) in DOUBLE."""
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, x: acc + x,
    )


def norm(v) -> Column:
    """Euclidean norm in DOUBLE."""
    return F.sqrt(dot(v, v))


def l2_normalize(v, floor: float = NORM_FLOOR) -> Column:
    """V / max(|v|, floor). A zero vector stays zero (never NaN).

    The norm is evaluated once per row (array_repeat), not per element."""
    v = _c(v)
    n = F.greatest(norm(v), F.lit(floor))
    return F.zip_with(v, F.array_repeat(n, F.size(v)),
                      lambda x, d: (x.cast("double") / d).cast("float"))


def cosine(a, b, floor: float = NORM_FLOOR) -> Column:
    """Cosine similarity with the same floor as P9: dot / (max(|a|,f)*max(|b|,f))."""
    return dot(a, b) / (F.greatest(norm(a), F.lit(floor)) * F.greatest(norm(b), F.lit(floor)))


def to_float32(v) -> Column:
    """Narrow to ARRAY<FLOAT>."""
    return _c(v).cast("array<float>")


def check_dim(v, dim: int, strict: bool = True) -> Column:
    """Vectors must have ``dim`` elements.

    strict -> the vector itself, or a task error naming the actual size;
    audit  -> a boolean 'bad dimension' flag (null vectors count as bad)."""
    v = _c(v)
    bad = F.coalesce(F.size(v) != F.lit(dim), F.lit(True))
    if not strict:
        return bad
    return F.when(
        bad,
        F.raise_error(F.concat(
            F.lit(DIM_ERROR), F.coalesce(F.size(v).cast("string"), F.lit("null")))),
    ).otherwise(v)


# ---------------------------------------------------------------------------
# numpy / Arrow kernels (run inside tasks)
# ---------------------------------------------------------------------------

def arrow_matrix(arr: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Arrow list<float> column -> contiguous float64 matrix [n, dim].

    Raises when a row is null or has another width: the caller decides the
    policy (P12) before vectors reach the kernel."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, dim), dtype=np.float64)
    if arr.null_count:
        raise ValueError("null vector reached the scoring kernel")
    lengths = pc.list_value_length(arr).to_numpy(zero_copy_only=False)
    if not np.all(lengths == dim):
        bad = int(lengths[lengths != dim][0])
        raise ValueError(f"{DIM_ERROR}{bad}")
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(n, dim)


def normalize_rows(m: np.ndarray, floor: float = NORM_FLOOR) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.maximum(n, floor)


def topk_columns(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per column (query) of ``scores`` [n, q], exactly the ``min(n, k)`` rows
    that lead by (score desc, id asc). Scores must be finite and are compared
    as they are, so callers round first. Returns (row, query, score)."""
    n, q = scores.shape
    if n == 0 or q == 0 or k <= 0:
        e = np.zeros(0, dtype=np.int64)
        return e, e, np.zeros(0)
    order = np.argsort(ids, kind="stable")
    scores = scores[order]                                    # ties now follow the id
    if n <= k:
        keep = np.ones(scores.shape, dtype=bool)
    else:
        kth = np.partition(scores, n - k, axis=0)[n - k]      # k-th largest per column
        above = scores > kth
        tied = scores == kth
        keep = above | (tied & (np.cumsum(tied, axis=0, dtype=np.int32) <= k - above.sum(axis=0)))
    rows, cols = np.nonzero(keep)
    return order[rows], cols, scores[rows, cols]


def finite_rows(m: np.ndarray) -> np.ndarray:
    """Which rows hold finite numbers only; others cannot be ranked."""
    return np.isfinite(m).all(axis=1)
