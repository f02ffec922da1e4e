"""Bucketed index: only touched buckets are rewritten, vectors stay on payload updates."""

import os

import pytest
from pyspark.sql import functions as F

from vecdex.operators import index
from vecdex.operators.buckets import BucketIndex, bucket_of
from vecdex.session import scratch_path, subfolders


def points(spark, n=5000):
    return spark.range(n).select("id", F.concat(F.lit("t"), "id").alias("title"), F.lit(None).cast("string").alias("thumbnail_url"),
                                 F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vector"))


def written(idx, v, part):
    return {int(f.split("=")[1]) for f in subfolders(idx.spark, os.path.join(idx.path, f"v={v}", part)) if f.startswith("bucket=")}


def content(df):
    return sorted((r.id, r.title, r.thumbnail_url, tuple(r.vector)) for r in df.select("id", "title", "thumbnail_url", "vector").collect())


def test_updates_rewrite_their_buckets_only(spark):
    base = points(spark, 2000)
    idx = BucketIndex.create(base, scratch_path(spark, "buckets"), 2, buckets=100)
    plain = index.VectorIndex.create(base, scratch_path(spark, "plain"), 2)
    assert idx.properties() == {"dim": 2, "metric": "cosine", "buckets": 100} and idx.points_count() == 2000
    delta = base.where("id % 100 = 3").withColumn("title", F.lit("new"))                 # one percent
    delta = delta.unionByName(delta.limit(2).withColumn("id", F.col("id") + 100_000))
    assert idx.upsert(delta) == 1 and plain.upsert(delta) == 1
    own = {r.b for r in delta.select(bucket_of("id", 100).alias("b")).distinct().collect()}
    assert written(idx, 1, "vectors") == written(idx, 1, "payload") == own and len(own) <= 22
    assert content(idx.read()) == content(plain.read())
    read = idx.spark.read.parquet(os.path.join(idx.path, "v=1", "payload")).count()
    assert read < 2000 * 22 / 100 * 1.6                                                # the rows of those buckets
    upd = spark.createDataFrame([(k, f"/{k}.jpg") for k in (1, 2, 100_003, 999_999)], "id long, thumbnail_url string")
    idx.set_payload(upd, ["thumbnail_url"]), plain.set_payload(upd, ["thumbnail_url"])
    assert written(idx, 2, "vectors") == set() and len(written(idx, 2, "payload")) <= 4
    assert content(idx.read()) == content(plain.read()) and content(idx.read(0)) == content(base)
    assert "vector" not in idx.payload().columns
    before = content(idx.read())
    assert idx.drop_superseded() > 0 and content(idx.read()) == before
    idx.upsert(delta)                                                                  # again: the same rows
    assert content(idx.read().drop("thumbnail_url").withColumn("thumbnail_url", F.lit(None))) == content(
        plain.read().drop("thumbnail_url").withColumn("thumbnail_url", F.lit(None)))


def test_lifecycle_and_failures(spark):
    path = scratch_path(spark, "buckets-life")
    idx = BucketIndex(spark, path)
    assert idx.versions() == [] and idx.points_count() == 0 and not idx.is_loaded()
    base = points(spark, 40)
    assert BucketIndex.create(base, path, 2, buckets=8).versions() == [0]
    BucketIndex.create(base.limit(3), path, 2)
    assert idx.versions() == [0] and idx.points_count() == 40                           # exists: skipped
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.join(local, "v=1", "payload", "bucket=0"))                      # a half-written version
    assert idx.current_version() == 0 and idx.points_count() == 40
    assert idx.upsert(base.where("id = 7").withColumn("title", F.lit("x"))) == 1        # replaces the debris
    assert idx.payload().where("title = 'x'").count() == 1 and idx.points_count() == 40
    assert idx.upsert(base.limit(0)) == 1 and idx.versions() == [0, 1]                  # nothing to do
    assert idx.set_payload(spark.createDataFrame([], "id long, title string"), ["title"]) == 1
    two = base.where("id = 1").withColumn("title", F.lit("a")).unionByName(base.where("id = 1"))
    with pytest.raises(Exception, match="several rows for key 1"):
        idx.upsert(two)
    assert idx.versions() == [0, 1] and idx.points_count() == 40
    with pytest.raises(Exception, match="unexpected vector dimension: 1"):
        idx.upsert(base.where("id = 1").withColumn("vector", F.array(F.lit(1.0).cast("float"))))
    with pytest.raises(index.IndexError_, match="unique"):
        BucketIndex.create(base.withColumn("id", F.lit(7).cast("long")), scratch_path(spark, "buckets-twice"), 2)
    BucketIndex.create(base.limit(3), path, 2, force=True)                             # made anew: older buckets do not show
    assert idx.points_count() == 3 and idx.properties()["buckets"] == 8 and len(idx.read().collect()) == 3
    empty = BucketIndex.create(base.limit(0), scratch_path(spark, "buckets-none"), 2, buckets=4)
    assert empty.points_count() == 0
    empty.upsert(base)
    assert content(empty.read()) == content(base)


def test_stream_touches_buckets_of_each_batch(spark):
    from vecdex.operators.embed import HashingEmbedder
    from vecdex.streaming.search import run_ingest_stream
    src = scratch_path(spark, "bucket-src")
    rows = spark.range(300).select("id", F.concat(F.lit("w"), "id").alias("text"))
    for k in range(3):
        rows.where(f"id % 3 = {k}").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    idx = BucketIndex(spark, scratch_path(spark, "bucket-idx"))
    run_ingest_stream(stream, idx, HashingEmbedder(4), "text", checkpoint=scratch_path(spark, "bucket-ckpt"), dim=4)
    assert sorted(r.id for r in idx.read().collect()) == list(range(300)) and len(idx.versions()) == 3


def test_upsert_query_with_keys_of_new_rows_taken(spark):
    """New keys that are those of an unchanged and of a changed part: the first row
    is replaced, the second stays beside the new one."""
    from vecdex.plans import catalog
    shape = "p_partkey long, p_name string, p_brand string, p_type string, p_size long, p_retailprice double"
    rows = [(1, "a", "b", "t", 50, 1.0), (2, "c", "b", "t", 50, 2.0), (3, "d", "b", "t", 1, 3.0),
            (1_000_001, "e", "b", "t", 50, 4.0), (1_000_002, "f", "b", "t", 1, 5.0)]
    d = scratch_path(spark, "taken-keys")
    spark.createDataFrame(rows, shape).write.parquet(os.path.join(d, "part.parquet"))
    got = sorted((r.p_partkey, r.p_name, r.p_retailprice) for r in catalog.REGISTRY["s8_upsert"](spark, d).collect())
    assert got == [(1, "a", 101.0), (2, "c", 102.0), (3, "d", 3.0), (1_000_001, "a", 1.0), (1_000_001, "e", 104.0),
                   (1_000_002, "c", 2.0), (2_000_001, "e", 4.0)]
