"""Index lifecycle (S5-S12, S14, P6, J3, A4, F3, F4) and enrichment (J5,
F8, S10)."""

import pytest
from pyspark.sql import functions as F

from vecdex.operators import enrich, ids, index
from vecdex.session import scratch_path


def _corpus(spark, n=5):
    rows = [(f"m{i}", f"T{i}", 2000 + i if i % 2 else None, ["g"], "s", i * 10)
            for i in range(n)]
    return spark.createDataFrame(rows, "movie_id string, title string, release_year int, "
                                       "genres array<string>, summary_snippet string, ordinal long")


def _vectors(spark, n=5, dim=3):
    return spark.createDataFrame([(i * 10, [float(i + 1)] * dim) for i in range(n)],
                                 "ordinal long, vector array<float>")


def test_dense_ids_follow_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = ids.dense_ids(df, "k", "pos", num_partitions=7).collect()
    assert sorted((r["k"], r["pos"]) for r in got) == [(i, i) for i in range(1000)]


def test_dense_ids_with_hot_key(spark):
    df = spark.range(0, 3000).select((F.when(F.col("id") < 1000, F.lit(0))
                                      .otherwise(F.col("id"))).alias("k"), "id")
    out = ids.dense_ids(df, "k", "pos", num_partitions=6)
    got = sorted((r["k"], r["pos"]) for r in out.collect())
    assert sorted(p for _, p in got) == list(range(3000))
    assert all(p < 1000 for k, p in got if k == 0)                  # key order kept
    parts = out.where(F.col("k") == 0).select(F.spark_partition_id()).distinct().count()
    assert parts > 1                                                 # hot key split


def test_build_points_zip_and_guard(spark):
    pts = index.build_points(_corpus(spark), _vectors(spark), key="ordinal").collect()
    assert sorted(r["id"] for r in pts) == list(range(5))
    assert all(r["thumbnail_url"] is None for r in pts)
    with pytest.raises(index.IndexError_):
        index.build_points(_corpus(spark), _vectors(spark, 4), key="ordinal")


def test_create_skip_force_upsert_set_payload(spark):
    path = scratch_path(spark, "idx-test")
    pts = index.build_points(_corpus(spark), _vectors(spark), key="ordinal")
    idx = index.VectorIndex.create(pts, path, 3)
    assert idx.versions() == [0] and idx.points_count() == 5 and idx.is_loaded()
    assert idx.properties() == {"dim": 3, "metric": "cosine", "partition_by": []}
    index.VectorIndex.create(pts, path, 3)                      # exists -> skipped
    assert idx.versions() == [0]
    assert "vector" not in idx.payload().columns
    base = idx.read()
    delta = (base.where(F.col("id") == 1).withColumn("title", F.lit("new"))
             .unionByName(base.where(F.col("id") == 1).withColumn("id", F.lit(99).cast("long"))))
    idx.upsert(delta)
    cur = {r["id"]: r["title"] for r in idx.read().collect()}
    assert cur[1] == "new" and 99 in cur and len(cur) == 6
    idx.upsert(delta)                                           # second application: no-op
    assert sorted(map(tuple, idx.read().drop("vector", "genres").collect())) == \
        sorted(map(tuple, idx.read(1).drop("vector", "genres").collect()))
    upd = spark.createDataFrame([(0, "/p0.jpg")], "id long, thumbnail_url string")
    idx.set_payload(upd, ["thumbnail_url"])
    cur = {r["id"]: r for r in idx.read().collect()}
    assert cur[0]["thumbnail_url"] == "/p0.jpg" and cur[0]["title"] == "T0"
    assert cur[2]["thumbnail_url"] is None
    assert index.any_enriched(idx.read()).first()[0] is True
    assert index.needs_enrichment(idx.read()).count() == 5
    h = index.health(idx.read(), 3).first()
    assert (h["points_count"], h["bad_dim"], h["enriched"]) == (6, 0, 1)
    index.VectorIndex.create(pts, path, 3, force=True)          # force -> new version
    assert idx.points_count() == 5


def test_partitioned_index_prunes_payload_filter(spark):
    from vecdex.plans.inspect import plan
    pts = index.build_points(_corpus(spark), _vectors(spark), key="ordinal").withColumn(
        "lang", F.when(F.col("id") % 2 == 0, "en").otherwise("de"))
    idx = index.VectorIndex.create(pts, scratch_path(spark, "idx-part"), 3, partition_by=["lang"])
    en = idx.read().where(F.col("lang") == "en")
    assert "PartitionFilters: [isnotnull(lang" in plan(en) and en.count() == 3
    idx.upsert(idx.read().where(F.col("id") == 1).withColumn("title", F.lit("u")))
    assert idx.properties()["partition_by"] == ["lang"]
    assert idx.read().where(F.col("title") == "u").first()["lang"] == "de"


def test_wrong_dim_rejected_at_create(spark):
    pts = index.build_points(_corpus(spark), _vectors(spark, dim=2), key="ordinal")
    with pytest.raises(Exception, match="unexpected vector dimension: 2"):
        index.VectorIndex.create(pts, scratch_path(spark, "idx-bad"), 3)


def test_missing_index_reads_as_empty(spark):
    idx = index.VectorIndex(spark, scratch_path(spark, "nothing"))
    assert idx.points_count() == 0 and not idx.is_loaded()
    f = spark.createDataFrame([], "thumbnail_url string")
    assert index.any_enriched(f).first()[0] is False


def test_artifact_guard(spark):
    pts = index.build_points(_corpus(spark), _vectors(spark), key="ordinal")
    out, js = scratch_path(spark, "art"), scratch_path(spark, "art-json")
    assert index.write_artifacts(pts, out, json_path=js) is True
    assert index.write_artifacts(pts, out, json_path=js) is False       # both exist: skip
    assert index.write_artifacts(pts, out, json_path=js, force=True) is True


CATALOGUE = [
    ("Alpha", 1999, 1, "/alpha.jpg"),
    ("Alpha", 2005, 2, "/alpha2.jpg"),
    ("Beta", 2001, 1, None),            # rank-1 path null, rank 2 set -> null
    ("Beta", 2001, 2, "/beta2.jpg"),
    ("Gamma", 2010, 1, ""),             # empty path -> not written
    ("Delta", 1980, 1, "/delta.jpg"),
]


def test_lookup_rules(spark):
    cat = spark.createDataFrame(CATALOGUE, "title string, year int, rank int, poster_path string")
    pts = spark.createDataFrame([
        (1, "Alpha", 2005, None), (2, "Alpha", None, None), (3, "Beta", 2001, None),
        (4, "Gamma", 2010, None), (5, "Nope", 2000, None), (6, "Delta", 1999, None),
        (7, "Alpha", 1999, "/kept.jpg"),
    ], "id long, title string, release_year int, thumbnail_url string")
    got = {r["id"]: r["poster_path"] for r in enrich.lookup(pts, cat).collect()}
    assert got == {1: "/alpha2.jpg", 2: "/alpha.jpg", 3: None, 4: None, 5: None, 6: None,
                   7: "/alpha.jpg"}
    once = enrich.enrich(pts, cat)
    out = {r["id"]: r["thumbnail_url"] for r in once.collect()}
    assert out[1] == "/alpha2.jpg" and out[7] == "/kept.jpg" and out[5] is None
    twice = enrich.enrich(once, cat)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_guard_states(spark):
    """{missing, one of two present, present but empty, unreadable} x force."""
    import os
    pts = index.build_points(_corpus(spark), _vectors(spark), key="ordinal")
    out, js = scratch_path(spark, "g-art"), scratch_path(spark, "g-json")
    pts.write.parquet(out)                                       # one of two present
    assert index.write_artifacts(pts, out, json_path=js) is True
    empty = scratch_path(spark, "g-empty")                       # present but empty
    pts.limit(0).write.parquet(empty)
    idx = index.VectorIndex.create(pts.limit(0), empty + "-idx", 3)
    assert idx.points_count() == 0 and not idx.is_loaded()
    bad = scratch_path(spark, "g-bad")                           # unreadable
    local = bad[len("file:"):] if bad.startswith("file:") else bad
    os.makedirs(os.path.join(local, "v=0"))
    with open(os.path.join(local, "v=0", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    idx = index.VectorIndex(spark, bad)
    assert idx.versions() == []                                  # never committed
    open(os.path.join(local, "v=0", "_SUCCESS"), "w").close()    # committed, now unreadable
    assert not idx.is_loaded()
    kept = index.VectorIndex.create(pts, bad, 3)                 # create does not replace it
    assert kept.versions() == [0]
    with pytest.raises(Exception):
        kept.read().count()


def test_half_written_version_is_not_read(spark):
    import os
    path = scratch_path(spark, "g-half")
    idx = index.VectorIndex.create(index.build_points(_corpus(spark), _vectors(spark), key="ordinal"), path, 3)
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.join(local, "v=1"))
    assert idx.current_version() == 0 and idx.points_count() == 5


def test_zip_needs_the_same_keys(spark):
    other = _vectors(spark).withColumn("ordinal", F.when(F.col("ordinal") == 10, 11).otherwise(F.col("ordinal")))
    with pytest.raises(Exception, match="no counterpart"):
        index.build_points(_corpus(spark), other, key="ordinal").count()


def test_updates_settle_duplicates(spark):
    path = scratch_path(spark, "g-dup")
    pts = index.build_points(_corpus(spark), _vectors(spark), key="ordinal")
    idx = index.VectorIndex.create(pts, path, 3)
    one = idx.read().where("id = 1")
    first, second = one.withColumn("title", F.lit("a")), one.withColumn("title", F.lit("b"))
    idx.upsert(first.unionByName(first))                         # the same row twice is one row
    assert [r.title for r in idx.read().where("id = 1").collect()] == ["a"]
    with pytest.raises(Exception, match="several rows for key 1"):
        idx.upsert(first.unionByName(second))
    both = first.withColumn("n", F.lit(1)).unionByName(second.withColumn("n", F.lit(2)))
    idx.upsert(both, seq_col="n")
    assert [r.title for r in idx.read().where("id = 1").collect()] == ["b"] and idx.points_count() == 5
    upd = spark.createDataFrame([(1, "/x", 1), (1, "/y", 2), (2, None, 1)], "id long, thumbnail_url string, n int")
    idx.set_payload(upd, ["thumbnail_url"], seq_col="n")
    assert idx.points_count() == 5 and idx.read().where("id = 1").first().thumbnail_url == "/y"
    with pytest.raises(index.IndexError_, match="unique"):
        index.VectorIndex.create(pts.withColumn("id", F.lit(7).cast("long")), scratch_path(spark, "g-twice"), 3)
