"""A vector index whose updates rewrite only the buckets they touch (S8, S10, ST2).

Rows are dealt by a hash of their id into ``buckets`` folders, vectors apart from
payload:

    <path>/v=<n>/vectors/bucket=<b>/    id, vector
    <path>/v=<n>/payload/bucket=<b>/    id, payload columns
    <path>/v=<n>/start                  the columns; only where the collection is made (anew)
    <path>/v=<n>/done                   written last: the version counts

The version that makes the collection holds every bucket, a later one only those
its update touched. A bucket
is read from the highest version that has it, so an upsert costs the touched
buckets of both parts and a payload update those of the payload alone. Folders of
a version are never changed, so readers of an older version are not disturbed and
a failed update leaves the index as it was; ``drop_superseded`` removes folders
that no later read needs.

``buckets`` is fixed when the index is made; ``buckets_for`` takes it from the row
count so that a bucket stays a bounded part of the index. A hash spreads ids
evenly, whatever they are, and a bucket of rows is cut over several files.
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.functions.vectors import check_dim, to_float32
from vecdex.operators.index import METRIC, IndexError_, VectorIndex, one_per_key, with_payload_updates
from vecdex.session import Scratch, exists, read_text, remove_folder, subfolders, write_text

#: rows of a bucket that ``buckets_for`` aims at
BUCKET_ROWS = 1_000_000
#: settled update rows up to this many are broadcast by their ids (8 bytes each)
BROADCAST_IDS = 4_000_000
_BUCKET = re.compile(r"bucket=(\d+)")
PARTS = ("vectors", "payload")


def buckets_for(rows: int) -> int:
    return max(8, -(-rows // BUCKET_ROWS))


class BucketIndex(VectorIndex):
    """The interface of ``VectorIndex`` over the layout above."""

    # -- S7 / S12 -----------------------------------------------------------
    @classmethod
    def create(cls, points: DataFrame, path: str, dim: int, *, metric: str = METRIC, force: bool = False,
               vec_col: str = "vector", buckets: int | None = None) -> "BucketIndex":
        """(Re)create the collection, or skip when one exists and ``force`` is off.
        Vectors are checked against ``dim`` and narrowed to float32."""
        idx = cls(points.sparkSession, path)
        found = idx.versions()
        if found and not force:
            return idx
        rows = points.withColumn(vec_col, to_float32(check_dim(F.col(vec_col), dim)))
        props = {"dim": dim, "metric": metric, "buckets": buckets or buckets_for(points.count())}
        idx._write_version(max(found, default=-1) + 1, rows.select("id", F.col(vec_col).alias("vector", metadata=props)),
                           rows.drop(vec_col), props["buckets"], start=True)
        return idx

    def _write_version(self, version: int, vectors: DataFrame | None, payload: DataFrame, buckets: int, start: bool = False) -> None:
        where = os.path.join(self.path, f"v={version}")
        remove_folder(self.spark, where)  # debris of an attempt that never counted
        parts = {part: rows for part, rows in zip(PARTS, (vectors, payload)) if rows is not None}
        for part, rows in parts.items():
            own = rows.withColumn("bucket", bucket_of("id", buckets))
            # dealt by bucket; a large bucket is cut over several tasks and files
            own.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(os.path.join(where, part))
        if start:
            # updates keep ids unique: they are settled to one row per id first
            written = self.spark.read.schema(payload.schema).parquet(os.path.join(where, "payload"))
            if written.groupBy("id").count().where("count > 1").limit(1).count():
                remove_folder(self.spark, where)
                raise IndexError_("ids must be unique")
            write_text(self.spark, os.path.join(where, "start"), json.dumps({p: r.schema.jsonValue() for p, r in parts.items()}))
        write_text(self.spark, os.path.join(where, "done"), "")

    def _shape(self, part: str, version: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(read_text(self.spark, os.path.join(self.path, f"v={version}", "start")))[part])

    # -- reads ----------------------------------------------------------------
    def versions(self) -> list[int]:
        found = [int(m.group(1)) for m in (re.fullmatch(r"v=(\d+)", f) for f in subfolders(self.spark, self.path)) if m]
        return sorted(v for v in found if exists(self.spark, os.path.join(self.path, f"v={v}", "done")))

    def folders(self, part: str, version: int | None = None) -> dict[int, str]:
        """The folder each bucket is read from, as of a version. Listings only."""
        out: dict[int, str] = {}
        for v in self._since_start(version):
            base = os.path.join(self.path, f"v={v}", part)
            names = [m for m in map(_BUCKET.fullmatch, subfolders(self.spark, base)) if m]
            out.update({int(m.group(1)): os.path.join(base, m.group(0)) for m in names})
        return out

    def _since_start(self, version: int | None = None) -> list[int]:
        """The versions from the one that made the collection to the one asked for."""
        versions = [v for v in self.versions() if version is None or v <= version]
        for at in range(len(versions) - 1, -1, -1):
            if exists(self.spark, os.path.join(self.path, f"v={versions[at]}", "start")):
                return versions[at:]
        raise IndexError_(f"no index at {self.path}")

    def _part(self, part: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        shape = self._shape(part, self._since_start(version)[0])
        paths = [p for b, p in sorted(self.folders(part, version).items()) if buckets is None or b in buckets]
        return self.spark.read.schema(shape).parquet(*paths) if paths else self.spark.createDataFrame([], shape)

    def vectors(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        return self._part("vectors", version, buckets)

    def payload(self, vec_col: str = "vector", version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Every column but the vector; vector files are not touched."""
        return self._part("payload", version, buckets)

    def read(self, version: int | None = None) -> DataFrame:
        """Whole rows: the two parts joined on the id."""
        payload = self.payload(version=version)
        return payload.join(self.vectors(version), "id").select(*payload.columns, "vector")

    def properties(self, vec_col: str = "vector") -> dict:
        return dict(self._shape("vectors", self._since_start()[0])["vector"].metadata)

    # -- S11 ----------------------------------------------------------------
    def points_count(self) -> int:
        try:
            return int(self.payload().count())
        except Exception:
            return 0

    # -- S8 -----------------------------------------------------------------
    def upsert(self, delta: DataFrame, *, seq_col: str | None = None) -> int:
        """Key upsert on ``id`` as in ``VectorIndex``: settled once, then the touched
        buckets of both parts are written anew. An empty delta changes nothing."""
        props = self.properties()
        work = Scratch(self.spark, "upsert")
        names = [*self._shape("payload", self._since_start()[0]).names, "vector"]
        rows = one_per_key(delta.withColumn("vector", to_float32(check_dim(F.col("vector"), props["dim"]))), "id", seq_col).select(*names)
        settled = work.write(rows.withColumn("bucket", bucket_of("id", props["buckets"])))
        version, touched, n = self._touched(settled)
        if touched:
            ids = F.broadcast(settled.select("id")) if n <= BROADCAST_IDS else settled.select("id")
            fresh = settled.drop("bucket")
            meta = F.col("vector").alias("vector", metadata=props)
            parts = [self._part(part, buckets=touched).join(ids, "id", "left_anti").unionByName(fresh.select(*columns))
                     for part, columns in zip(PARTS, (["id", "vector"], [c for c in names if c != "vector"]))]
            self._write_version(version, parts[0].select("id", meta), parts[1], props["buckets"])
        work.close()
        return version if touched else self.current_version()

    # -- S10 ----------------------------------------------------------------
    def set_payload(self, updates: DataFrame, columns: list[str], *, seq_col: str | None = None) -> int:
        """Partial payload update by id, as in ``VectorIndex``: the touched buckets of
        the payload are written anew, vectors stay where they are."""
        buckets = self.properties()["buckets"]
        work = Scratch(self.spark, "set-payload")
        order = [seq_col] if seq_col and seq_col not in columns else []
        own = work.write(updates.select("id", *columns, *order).withColumn("bucket", bucket_of("id", buckets)))
        version, touched, _ = self._touched(own)
        if touched:
            new = with_payload_updates(self.payload(buckets=touched), own.drop("bucket"), columns, seq_col=seq_col)
            self._write_version(version, None, new, buckets)
        work.close()
        return version if touched else self.current_version()

    def _touched(self, rows: DataFrame) -> tuple[int, list[int], int]:
        """The next version, the buckets (at most all there are) with rows, and the rows."""
        found = {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        return self.current_version() + 1, sorted(found), sum(found.values())

    def drop_superseded(self) -> int:
        """Remove the folders that the current version does not read; how many."""
        gone = 0
        for part in PARTS:
            used = set(self.folders(part).values())
            for v in self.versions():
                base = os.path.join(self.path, f"v={v}", part)
                for name in subfolders(self.spark, base):
                    if _BUCKET.fullmatch(name) and os.path.join(base, name) not in used:
                        remove_folder(self.spark, os.path.join(base, name))
                        gone += 1
        return gone


def bucket_of(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int")
