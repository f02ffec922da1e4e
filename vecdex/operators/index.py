"""Vector index storage and maintenance.

An index is a directory of parquet versions ``<path>/v=<n>/``. Every write
(create, upsert, payload update) produces a new version and never rewrites
the one being read; readers take the highest version whose job committed
(``_SUCCESS``). A store that cannot be read raises and is never taken for an
empty one. The vector
column carries its properties (``dim``, ``metric``) as Spark column metadata,
which travels inside the parquet files.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecdex.functions.vectors import check_dim, norm, to_float32
from vecdex.operators.ids import dense_ids
from vecdex.session import committed, remove_folder, subfolders, within_bytes

METRIC = "cosine"
_VERSION_RE = re.compile(r"v=(\d+)")


class IndexError_(RuntimeError):
    pass


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions."""
    found = [int(m.group(1)) for m in map(_VERSION_RE.fullmatch, subfolders(spark, path)) if m]
    return sorted(v for v in found if committed(spark, os.path.join(path, f"v={v}")))


def build_points(corpus: DataFrame, vectors: DataFrame | None = None, *,
                 order_by: str = "ordinal", vec_col: str = "vector",
                 key: str | None = None) -> DataFrame:
    """S6 + P6 (+ J3): dense 0-based ``id`` in corpus order, the vector on
    the row and ``thumbnail_url`` forced to null.

    When ``vectors`` is a separate frame it is zipped on ``key`` (J3); the
    two sides must hold the same number of rows and the same keys, or the
    build fails."""
    df = corpus
    if vectors is not None:
        k = key or order_by
        n_left, n_right = corpus.count(), vectors.count()
        if n_left != n_right:
            raise IndexError_(f"row counts differ: {n_right} vectors for {n_left} records")
        both = corpus.withColumn("_l", F.lit(True)).join(
            vectors.select(k, vec_col).withColumn("_r", F.lit(True)), k, "full")
        paired = F.when(F.col("_l") & F.col("_r"), F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit("no counterpart for key "), F.coalesce(F.col(k).cast("string"), F.lit("null")))).cast("boolean"))
        df = both.where(paired).drop("_l", "_r")
    df = df.withColumn("thumbnail_url", F.lit(None).cast("string"))
    return dense_ids(df, order_by=order_by, out_col="id")


class VectorIndex:
    """A versioned parquet index at ``path`` (collection)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    # -- S7 / S12 -----------------------------------------------------------
    @classmethod
    def create(cls, points: DataFrame, path: str, dim: int, *, metric: str = METRIC,
               force: bool = False, vec_col: str = "vector",
               partition_by: list[str] | None = None) -> "VectorIndex":
        """(Re)create the collection: the first version, or a skip when one
        exists and ``force`` is off (S12). Vectors are checked against
        ``dim`` (P12) and narrowed to float32 (P11). ``partition_by`` lays the
        files out by low-cardinality payload columns (e.g. language), so a
        payload pre-filter (F5) on them prunes whole folders at the scan."""
        idx = cls(points.sparkSession, path)
        if idx.versions() and not force:
            return idx
        start = (max(idx.versions()) + 1) if idx.versions() else 0
        idx._write(points.withColumn(vec_col, to_float32(check_dim(F.col(vec_col), dim))),
                   start, {"dim": dim, "metric": metric,
                           "partition_by": list(partition_by or [])}, vec_col)
        return idx

    def _write(self, df: DataFrame, version: int, props: dict,
               vec_col: str = "vector") -> None:
        out = df.withColumn(vec_col, F.col(vec_col).alias(vec_col, metadata=props))
        w = out.write.mode("overwrite")
        if props.get("partition_by"):
            w = w.partitionBy(*props["partition_by"])
        # ``version`` is past every committed version, so anything already at
        # this path is debris of a failed attempt and may be replaced
        where = os.path.join(self.path, f"v={version}")
        w.parquet(where)
        twice = self.spark.read.parquet(where).groupBy("id").count().where("count > 1").limit(1).count()
        if twice:
            remove_folder(self.spark, where)
            raise IndexError_("ids must be unique")

    # -- reads ----------------------------------------------------------------
    def versions(self) -> list[int]:
        return _versions(self.spark, self.path)

    def current_version(self) -> int:
        vs = self.versions()
        if not vs:
            raise IndexError_(f"no index at {self.path}")
        return vs[-1]

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        return self.spark.read.parquet(os.path.join(self.path, f"v={v}"))

    def properties(self, vec_col: str = "vector") -> dict:
        return dict(self.read().schema[vec_col].metadata)

    def payload(self, vec_col: str = "vector") -> DataFrame:
        """Every column but the vector (pruned from the parquet scan)."""
        df = self.read()
        return df.select([c for c in df.columns if c != vec_col])

    # -- S11 ----------------------------------------------------------------
    def points_count(self) -> int:
        try:
            return int(self.read().count())
        except Exception:
            return 0

    def is_loaded(self) -> bool:
        return self.points_count() > 0

    # -- S8 -----------------------------------------------------------------
    def upsert(self, delta: DataFrame, *, seq_col: str | None = None) -> int:
        """Key upsert on ``id``: rows of ``delta`` replace same-id rows, new ids
        are added. Of several delta rows per id the one with the highest
        ``seq_col`` wins; different rows that tie, or differ without a
        ``seq_col``, raise. Written as a new version; returns its number."""
        props = self.properties()
        base = self.read()
        new = upserted(base, one_per_key(delta, "id", seq_col).select(*base.columns), "id")
        v = self.current_version() + 1
        self._write(new, v, props)
        return v

    # -- S10 ----------------------------------------------------------------
    def set_payload(self, updates: DataFrame, columns: list[str], *, seq_col: str | None = None) -> int:
        """Partial payload update by id: listed columns take the update's
        non-null value; every other column is untouched. Several updates for an
        id are settled as in ``upsert``."""
        props = self.properties()
        new = with_payload_updates(self.read(), updates, columns, seq_col=seq_col)
        v = self.current_version() + 1
        self._write(new, v, props)
        return v


def one_per_key(df: DataFrame, key: str, seq_col: str | None = None) -> DataFrame:
    """One row per key: the last by ``seq_col`` (not part of the result unless
    it is a payload column of the same name). Rows that are the same count once;
    different rows that nothing tells apart raise. Two hash aggregates, the
    first combined map side."""
    cols = [c for c in df.columns if c != key]
    seq = F.col(seq_col) if seq_col else F.lit(0)
    row = F.struct(*[F.col(c) for c in cols])
    each = df.groupBy(key, seq.alias("_seq")).agg(
        F.first(row).alias("_row"), F.min(F.xxhash64(row)).alias("_lo"), F.max(F.xxhash64(row)).alias("_hi"))
    last = each.groupBy(key).agg(F.max_by(F.struct("_row", "_lo", "_hi"), F.col("_seq")).alias("_last"))
    clash = F.raise_error(F.concat(F.lit("several rows for key "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    checked = F.when(F.col("_last._lo") == F.col("_last._hi"), F.col("_last._row")).otherwise(
        clash.cast(each.schema["_row"].dataType))
    return last.select(key, checked.alias("_row")).select(key, "_row.*")


def latest_per_key(df: DataFrame, key: str, seq_col: str) -> DataFrame:
    """Last-write-wins per key (hash aggregate with map-side combine)."""
    cols = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(seq_col)).alias("_r"))
    return agg.select(key, "_r.*")


def upserted(base: DataFrame, delta: DataFrame, key: str = "id") -> DataFrame:
    """``base`` minus the delta keys, plus the delta (one row per key). The
    delta's keys are broadcast only while they take few bytes."""
    keys = delta.select(key)
    if within_bytes(keys):
        keys = F.broadcast(keys)
    return base.join(keys, key, "left_anti").unionByName(delta)


def with_payload_updates(base: DataFrame, updates: DataFrame, columns: list[str], *,
                         key: str = "id", seq_col: str | None = None) -> DataFrame:
    """S10 as a DataFrame transform: coalesce(update, current) per column, with
    the updates settled to one row per key first."""
    order = [seq_col] if seq_col and seq_col not in columns else []
    u = one_per_key(updates.select(key, *columns, *order), key, seq_col)
    u = u.select(key, *[F.col(c).alias(f"_u_{c}") for c in columns])
    if within_bytes(u):
        u = F.broadcast(u)
    joined = base.join(u, key, "left")
    return joined.select(*[F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in columns
                           else F.col(c) for c in base.columns])


def health(points: DataFrame, dim: int, vec_col: str = "vector") -> DataFrame:
    """A4: one-row report: count, missing/empty vectors, wrong width,
    enriched rows, min/max norm."""
    v = F.col(vec_col)
    has_thumb = "thumbnail_url" in points.columns
    return points.agg(
        F.count(F.lit(1)).alias("points_count"),
        F.sum(F.when(v.isNull() | (F.size(v) == 0), 1).otherwise(0)).alias("missing_vectors"),
        F.sum(F.when(F.coalesce(F.size(v) != dim, F.lit(True)), 1).otherwise(0)).alias("bad_dim"),
        (F.sum(F.when(F.col("thumbnail_url").isNotNull(), 1).otherwise(0)) if has_thumb
         else F.lit(0)).alias("enriched"),
        F.round(F.min(norm(v)), 6).alias("min_norm"),
        F.round(F.max(norm(v)), 6).alias("max_norm"),
    )


def any_set(col: str = "thumbnail_url") -> Column:
    """F4 / A6 as an aggregate: does any row have a non-null ``col``?"""
    return F.coalesce(F.bool_or(F.col(col).isNotNull()), F.lit(False))


def is_missing(col: str = "thumbnail_url") -> Column:
    """F3 as a predicate: the row still needs enrichment."""
    return F.col(col).isNull()


def any_enriched(points: DataFrame, col: str = "thumbnail_url") -> DataFrame:
    """One row, false when the input is empty."""
    return points.agg(any_set(col).alias("any_enriched"))


def needs_enrichment(points: DataFrame, col: str = "thumbnail_url") -> DataFrame:
    """rows whose ``col`` is null (pushed into the parquet scan)."""
    return points.where(is_missing(col))


def write_artifacts(points: DataFrame, path: str, *, force: bool = False,
                    json_path: str | None = None) -> bool:
    """S5 + S12: one parquet table (vector on the row) and optionally the
    record columns as JSON. Skips (returns False) when every output exists
    and ``force`` is off; ``force`` overwrites."""
    spark = points.sparkSession
    outputs = [path] + ([json_path] if json_path else [])
    if not force and all(committed(spark, p) for p in outputs):
        return False
    # a missing or partial output set is rebuilt completely
    points.write.mode("overwrite").parquet(path)
    if json_path:
        points.drop("vector").write.mode("overwrite").json(json_path)
    return True
