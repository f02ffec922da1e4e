"""Plan assertions: top-k limits pushed around the shuffle, pruned scans,
pushed filters, bounded broadcasts."""

import os

from pyspark.sql import functions as F

from vecdex.operators import enrich, index, search
from vecdex.plans import catalog
from vecdex.plans.inspect import plan, pushed_filters, read_schemas
from vecdex.sources.tables import embeddings_index
from conftest import SF_ORACLE


def test_k2_uses_window_group_limit(spark):
    p = plan(catalog.REGISTRY["k2_topk"](spark, SF_ORACLE))
    assert "WindowGroupLimit" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_payload_scan_prunes_vector(spark):
    idx = embeddings_index(spark, SF_ORACLE)
    hits = spark.createDataFrame([(0, 1, 5, 0.9)], "qid long, rank int, id long, score double")
    out = search.attach_payload(hits, idx, ["label"], rows_bound=1)
    schemas = read_schemas(out)
    assert schemas and all("embedding" not in s for s in schemas)
    assert "BroadcastHashJoin" in plan(out)


def test_null_filter_and_prefilter_pushed(spark):
    from vecdex.session import scratch_path
    pts = spark.read.parquet(os.path.join(SF_ORACLE, "documents.parquet"))
    assert any("lang" in f for f in pushed_filters(pts.where(F.col("lang") == "en")))
    path = scratch_path(spark, "plan-idx")
    (pts.select(F.col("doc_id").alias("id"), "lang",
                F.when(F.col("doc_id") % 2 == 0, F.lit("/x.jpg")).alias("thumbnail_url"))
     .write.parquet(path))
    todo = index.needs_enrichment(spark.read.parquet(path))
    assert any("IsNull(thumbnail_url)" in f for f in pushed_filters(todo))
    assert todo.count() == pts.count() // 2


def test_lookup_joins_are_many_to_one(spark):
    pts = catalog._part_points(spark, SF_ORACLE)
    cat = catalog._part_catalogue(spark, SF_ORACLE)
    out = enrich.lookup(pts, cat)
    assert out.count() == pts.count()                  # never more rows than points


def test_text_search_plan_has_no_pair_join(spark):
    p = plan(catalog.REGISTRY["u3_search"](spark, SF_ORACLE))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "MapInArrow" in p or "PythonMapInArrow" in p


def test_embedding_udf_evaluated_once(spark):
    import re
    for key in ("u5_hash_embed", "u3_search", "p10_masked_pool", "k3_suggest"):
        p = plan(catalog.REGISTRY[key](spark, SF_ORACLE), "simple")
        assert len(re.findall(r"ArrowEvalPython", p)) <= 1, key
