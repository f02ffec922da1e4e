"""Embedders (U1, U2, U4, U5) and pooling (P10, A5).

An embedder is any object with ``embed(df, text_col, out_col) -> DataFrame``;
search and index builders take one as an argument (U4: no global switch).

* ``StubEmbedder`` (U2): the deterministic stand-in, +0.1 at even and -0.1 at
  odd positions for any text. Pure SQL.
* ``HashingEmbedder`` (U5): lexical feature hashing. Tokenising runs in the
  JVM (regex split); one Arrow UDF hashes each distinct token of a batch once
  (md5: bucket from the first 8 hex digits mod dim, sign from the 9th; hashes of
  frequent tokens are remembered) and fills the batch's dense signed counts with
  a single ``bincount``. Row-wise map, never a shuffle.
* ``ModelEmbedder`` (U1): an injected batch model through
  ``predict_batch_udf``, built once per Python worker and fed fixed-size
  batches (K6).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.session import balance

# --- fixed values -----------------------------------------------------------
STUB_VALUE = 0.1               # U2: +0.1 at even, -0.1 at odd index
MODEL_BATCH = 64               # U1 texts per model call
# U5 token hashes remembered per worker process, about 0.15 kB each
TOKEN_MEMO = 500_000
# U5 token rule: maximal runs of Unicode letters/digits of the lower-cased text
TOKEN_SPLIT_RE = r"[^\p{L}\p{N}]+"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


class StubEmbedder:
    """The same alternating vector for every text."""

    def __init__(self, dim: int = 384):
        self.dim = dim

    def vector(self) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(self.dim - 1)),
                           lambda i: F.when(i % 2 == 0, F.lit(STUB_VALUE))
                           .otherwise(F.lit(-STUB_VALUE)).cast("float"))

    def values(self) -> list[float]:
        return [float(np.float32(STUB_VALUE if i % 2 == 0 else -STUB_VALUE))
                for i in range(self.dim)]

    def embed(self, df: DataFrame, text_col: str, out_col: str = "vector") -> DataFrame:
        return df.withColumn(out_col, self.vector())


def hash_tokens(text) -> Column:
    """U5 tokens: lower-case, split on non letter/digit runs, drop empties."""
    return F.filter(F.split(F.lower(_c(text)), TOKEN_SPLIT_RE), lambda t: t != "")


class _TokenHashes(dict):
    """First five bytes of a token's md5 as one number, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        code = int.from_bytes(hashlib.md5(token.encode("utf-8")).digest()[:5], "big")
        if len(self) < TOKEN_MEMO and len(token) < 100:
            self[token] = code
        return code


_HASHES = _TokenHashes()


def _hash_token_table(tokens: "pa.Array", dim: int) -> tuple[np.ndarray, np.ndarray]:
    """md5-based (bucket, sign) for each distinct token of an Arrow array: bucket
    from the first four bytes, sign from the top bit of the fifth."""
    code = np.fromiter(map(_HASHES.__getitem__, tokens.to_pylist()), np.int64, len(tokens))
    return (code >> 8) % dim, np.where(code & 0x80, -1.0, 1.0)


def _tokens_to_dense(dim: int):
    """Arrow UDF: list<string> tokens -> list<float> signed bucket counts.

    Tokens of the whole batch are dictionary-encoded (C++), each distinct
    token is hashed once, and one ``bincount`` fills the batch matrix."""
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def dense(toks: pa.Array) -> pa.Array:
        if isinstance(toks, pa.ChunkedArray):
            toks = toks.combine_chunks()
        n = len(toks)
        lens = pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False)
        flat = toks.flatten()
        out = np.zeros(n * dim, dtype=np.float64)
        if len(flat):
            enc = pc.dictionary_encode(flat)
            b, sg = _hash_token_table(enc.dictionary, dim)
            codes = enc.indices.to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(n), lens)
            out = np.bincount(rows * dim + b[codes], weights=sg[codes], minlength=n * dim)
        values = pa.array(out.astype(np.float32))
        offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
        arr = pa.ListArray.from_arrays(offsets, values)
        if toks.null_count:
            mask = toks.is_null()
            arr = pc.if_else(mask, pa.nulls(n, arr.type), arr)
        return arr
    return dense


class HashingEmbedder:
    """Signed feature-hashing counts (unnormalised; cosine normalises)."""

    def __init__(self, dim: int = 64):
        self.dim = dim
        self._dense = _tokens_to_dense(dim)

    def vector(self, text) -> Column:
        return self._dense(hash_tokens(text))

    def embed(self, df: DataFrame, text_col: str, out_col: str = "vector") -> DataFrame:
        return balance(df).withColumn(out_col, self.vector(text_col))

    def sparse(self, df: DataFrame, key: str, text_col: str) -> DataFrame:
        """(key, pos, value) rows of the non-zero buckets: the dense vectors of a
        batch, unrolled where they lie. No shuffle."""
        rows = balance(df.select(key, text_col)).select(key, F.posexplode(self.vector(text_col)).alias("pos", "value"))
        return rows.where(F.col("value") != 0)


def mean_pool(token_vectors, mask) -> Column:
    """P10: masked mean over tokens, per row (no shuffle).

    ``token_vectors`` ARRAY<ARRAY<FLOAT>> (seq x dim), ``mask`` ARRAY<INT>.
    An all-zero mask gives null (the reference produces NaN)."""
    tv, m = _c(token_vectors), _c(mask)
    kept = F.filter(F.arrays_zip(tv.alias("v"), m.alias("m")), lambda z: z["m"] != 0)
    dim = F.size(F.element_at(tv, 1))
    zero = F.array_repeat(F.lit(0.0).cast("double"), dim)
    total = F.aggregate(kept, zero, lambda acc, z: F.zip_with(
        acc, z["v"], lambda a, b: a + b.cast("double")))
    cnt = F.size(kept)
    return F.when(cnt > 0, F.zip_with(total, F.array_repeat(cnt.cast("double"), dim),
                                      lambda a, n: a / n))


def mean_pool_by_key(df: DataFrame, key: str | list[str], vec_col: str,
                     mask_col: str | None = None) -> DataFrame:
    """A5: masked mean of vectors grouped by ``key`` -> (key..., pos, value).

    Vectors are added up as vectors, one partial sum per group and map task (a hot
    key is combined there), and unrolled once per group. Null vectors and rows
    that are masked out do not count; a group without any has no rows. Vectors of
    a group must have one width and no null elements."""
    keys = [key] if isinstance(key, str) else list(key)
    src = df if mask_col is None else df.where(F.col(mask_col) != 0)
    # unwrapped by a generator, which the null check cannot pass: an embedding UDF
    # that feeds the vectors is evaluated once
    rows = src.select(*keys, F.explode_outer(F.array(vec_col)).alias("_v")).where(F.size("_v") > 0)
    pooled = rows.groupBy(*keys).agg(Summarizer.mean(array_to_vector("_v")).alias("_mean"))
    return pooled.select(*keys, F.posexplode(vector_to_array("_mean")).alias("pos", "value"))


class ModelEmbedder:
    """Any batch model through ``predict_batch_udf``.

    ``predict_fn_factory`` is called once per Python worker and returns a
    function from a numpy array of texts to float32 rows of width ``dim``; it
    brings its own tokenizer, weights and pooling (P10 has a column form,
    ``mean_pool``). A null text gives a null vector."""

    def __init__(self, predict_fn_factory, dim: int = 384, batch_size: int = MODEL_BATCH):
        self.factory, self.dim, self.batch_size = predict_fn_factory, dim, batch_size

    def embed(self, df: DataFrame, text_col: str, out_col: str = "vector") -> DataFrame:
        from pyspark.ml.functions import predict_batch_udf
        udf = predict_batch_udf(self.factory, return_type=T.ArrayType(T.FloatType()),
                                batch_size=self.batch_size)
        text = F.col(text_col)
        vector = udf(F.coalesce(text, F.lit("")))
        return balance(df).withColumn(out_col, F.when(text.isNotNull(), vector))
