"""Vectors and search (P9-P13, K1-K5, J4, A1, A2, S13, U1-U5, K4) against
brute force on literal rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecdex.functions import vectors as vx
from vecdex.operators import embed, ivf, search, topk
from vecdex.plans import catalog
from conftest import SF_ORACLE


def _index(spark, vecs):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                                 "id long, vector array<float>")


def brute(index_vecs, qvecs, k):
    a = np.asarray(index_vecs, dtype=np.float64)
    a = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)
    out = {}
    for qi, q in enumerate(qvecs):
        q = np.asarray(q, dtype=np.float64)
        q = q / max(np.linalg.norm(q), 1e-9)
        s = np.round(a @ q, 6)
        order = sorted(range(len(a)), key=lambda i: (-s[i], i))[:k]
        out[qi] = [(i, s[i]) for i in order]
    return out


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 0.0]),
                                ([1.0, 0.0], [-1.0, 0.0])], "a array<float>, b array<float>")
    r = df.select(vx.norm("a").alias("n"), vx.l2_normalize("a").alias("u"),
                  vx.cosine("a", "b").alias("c"), vx.dot("a", "b").alias("d")).collect()
    assert r[0]["n"] == 5.0 and r[0]["u"] == pytest.approx([0.6, 0.8])
    assert r[0]["c"] == pytest.approx(1.0)
    assert r[1]["u"] == [0.0, 0.0] and r[1]["c"] == 0.0       # zero vector: no NaN
    assert r[2]["c"] == pytest.approx(-1.0)                    # never clipped


def test_dim_check(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<float>")
    flags = [r[0] for r in df.select(vx.check_dim("v", 2, strict=False)).collect()]
    assert flags == [False, True, True]
    with pytest.raises(Exception, match="unexpected vector dimension: "):
        df.select(vx.check_dim("v", 2)).collect()


def test_knn_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(60, 8)).round(1)
    vecs[10] = vecs[3]                                          # exact tie -> id order
    vecs[11] = vecs[3] * 2
    vecs[20] = 0.0                                              # zero vector
    idx = _index(spark, vecs)
    q = idx.where(F.col("id") < 15).select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    want = brute(vecs, vecs[:15], 5)
    for cfg in (topk.DEFAULT, topk.SearchConfig(broadcast_bytes=64, query_block_rows=4,
                                                corpus_block_rows=7)):
        got = topk.knn(idx, q, 8, 5, config=cfg).orderBy("qid", "rank").collect()
        by_q = {}
        for r in got:
            by_q.setdefault(r["qid"], []).append((r["id"], r["score"]))
        assert by_q == want


def test_per_query_limit_and_cap(spark):
    idx = _index(spark, np.eye(4))
    q = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0], 2), (1, [0.0, 1.0, 0.0, 0.0], 10)],
                              "qid long, qvec array<double>, k int")
    got = topk.knn(idx, q, 4, k_col="k").groupBy("qid").count().collect()
    assert {r["qid"]: r["count"] for r in got} == {0: 2, 1: 4}      # min(limit, available)


def test_broadcast_cap_counts_null_queries(spark):
    idx = _index(spark, np.eye(4))
    rows = [(0, None)] + [(i, [1.0, 0.0, 0.0, float(i)]) for i in range(1, 4)]
    q = spark.createDataFrame(rows, "qid long, qvec array<double>")
    # budget for 3 rows: 4 raw rows (one null) must take the block path
    cfg = topk.SearchConfig(broadcast_bytes=3 * 8 * 4, query_block_rows=2, corpus_block_rows=2)
    got = topk.knn(idx, q, 4, 1, config=cfg).select("qid").distinct().collect()
    assert sorted(r["qid"] for r in got) == [1, 2, 3]


def test_single_query(spark):
    idx = _index(spark, np.eye(4))
    assert topk.knn_single(idx, [0, 1, 0, 0], 4, 0).count() == 0
    rows = topk.knn_single(idx, [0, 1, 0, 0], 4, 10).collect()
    assert [r["id"] for r in rows] == [1, 0, 2, 3] and rows[0]["score"] == 1.0


def test_stub_embedder(spark):
    v = spark.createDataFrame([("anything",)], "t string")
    vec = embed.StubEmbedder(6).embed(v, "t").first()["vector"]
    assert vec == pytest.approx([0.1, -0.1] * 3)


def test_hashing_embedder_counts(spark):
    df = spark.createDataFrame([(1, "Red red BLUE"), (2, ""), (3, None), (4, "¡¿!")],
                               "id long, t string")
    rows = {r["id"]: r["vector"] for r in embed.HashingEmbedder(16).embed(df, "t").collect()}
    assert sum(abs(x) for x in rows[1]) in (1.0, 3.0)           # red x2 (+/-) and blue
    assert rows[2] == [0.0] * 16 and rows[4] == [0.0] * 16
    assert rows[3] is None


def test_mean_pool_row_and_table_forms(spark):
    df = spark.createDataFrame([
        (1, [[1.0, 2.0], [3.0, 4.0]], [1, 1]),
        (2, [[1.0, 2.0], [9.0, 9.0]], [1, 0]),
        (3, [[1.0, 2.0], [3.0, 4.0]], [0, 0]),
    ], "id long, tok array<array<float>>, mask array<int>")
    got = {r["id"]: r["p"] for r in df.select("id", embed.mean_pool("tok", "mask").alias("p")).collect()}
    assert got == {1: [2.0, 3.0], 2: [1.0, 2.0], 3: None}


def test_model_embedder_with_injected_model(spark):
    def factory():
        def predict(texts):
            return np.stack([[len(str(t)), 1.0] for t in texts]).astype(np.float32)
        return predict
    df = spark.createDataFrame([("ab",), ("abcd",), (None,)], "t string")
    out = {r["t"]: r["vector"] for r in embed.ModelEmbedder(factory, dim=2, batch_size=1).embed(df, "t").collect()}
    assert out == {"ab": [2.0, 1.0], "abcd": [4.0, 1.0], None: None}


def test_responses_nested_and_zero_hits(spark):
    idx = _index(spark, [[1.0, 0.0], [0.0, 1.0]])
    q = spark.createDataFrame([(1, "hello", 1), (2, "   ", 5)], "qid long, query string, limit int")
    stub = embed.StubEmbedder(2)
    hits = search.search_hits(q, idx, stub, 2)
    resp = {r["qid"]: r for r in search.responses(q, hits, ["id", "score"]).collect()}
    assert resp[1]["count"] == 1 and resp[1]["requested_limit"] == 1
    assert resp[2]["count"] == 0 and resp[2]["results"] == [] and resp[2]["error"]
    js = search.response_json(search.responses(q, hits, ["id", "score"])).collect()
    assert any('"results":[{"id":' in r["json"] for r in js)


def test_ivf_full_probe_equals_exact(spark):
    idx = catalog.embeddings_index(spark, SF_ORACLE)
    q = idx.where(F.col("id") % 50 == 0).select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    iv = ivf.IVFIndex.build(idx, 64, 8)
    exact = topk.knn(idx, q, 64, 10)
    full = iv.search(q, 10, nprobe=8, corpus_block_rows=40, query_block_rows=3)
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, full.collect()))
    rec = ivf.recall_at_k(iv.search(q, 10, nprobe=2), exact).first()["recall"]
    assert 0.0 < rec <= 1.0
    from vecdex.session import scratch_path
    path = scratch_path(spark, "ivf")
    iv.save(path)
    back = ivf.IVFIndex.load(spark, path, 64)
    assert sorted(map(tuple, back.search(q, 10, nprobe=2).collect())) == \
        sorted(map(tuple, iv.search(q, 10, nprobe=2).collect()))


@pytest.mark.parametrize("folder", [SF_ORACLE, "/root/testdata/sf0.1"])
def test_ivf_query_reaches_the_recall(spark, folder):
    from vecdex.plans import extra
    idx = catalog.embeddings_index(spark, folder)
    q = idx.select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    exact = topk.knn(idx, q, 64, 10)
    assert ivf.recall_at_k(extra.k4_ivf_topk(spark, folder), exact).first()["recall"] >= 0.9
    some = exact.where("qid % 50 = 0")
    assert ivf.recall_at_k(extra.k4_ivf_topk(spark, folder), some).first()["recall"] >= 0.9


def test_ivf_tuning(spark):
    from vecdex.session import scratch_path
    r = np.random.default_rng(6)
    idx = _index(spark, r.normal(size=(400, 8)))
    q = idx.where("id % 4 = 0").select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    exact = topk.knn(idx, q, 8, 10)
    iv = ivf.IVFIndex.build(idx, 8, 20)
    assert iv.nprobe == 20                                      # not tuned: every list
    curve, n = iv.recall_curve(q, exact)
    assert n == 1000 and len(curve) == 20 and curve == sorted(curve) and curve[-1] == 1.0
    for p in (1, 5):
        assert ivf.recall_at_k(iv.search(q, 10, nprobe=p), exact).first()["recall"] == pytest.approx(curve[p - 1])
    assert curve[iv.tune(q, exact).nprobe - 1] >= 0.9 and iv.nprobe < 20
    path = scratch_path(spark, "ivf-tuned")
    iv.save(path)
    assert ivf.IVFIndex.load(spark, path, 8).nprobe == iv.nprobe
    assert iv.tune(q.limit(0), exact.limit(0)).nprobe == 20


def test_scroll_pages_cover_index(spark):
    docs = spark.range(0, 250).select(F.col("id"), (F.col("id") % 3).alias("g"))
    pred = F.col("g") != 1
    seen, after = [], None
    while True:
        page = [r["id"] for r in search.scroll(docs, pred, after, page_size=40).collect()]
        if not page:
            break
        seen += page
        after = page[-1]
    want = [i for i in range(250) if i % 3 != 1]
    assert seen == want
    pages = {r["id"]: r["page"] for r in search.page_numbers(docs, 40, predicate=pred).collect()}
    assert [pages[i] for i in want] == [n // 40 for n in range(len(want))]


def _kernel_paths():
    return [topk.DEFAULT, topk.SearchConfig(broadcast_bytes=1, query_block_rows=2, corpus_block_rows=40)]


@pytest.mark.parametrize("config", _kernel_paths())
def test_topk_hard_cases(spark, config):
    """Zero queries, equal rows, non-finite rows, and limits above the API's cap."""
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(200, 4)))]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(100)]
    rows += [(2000 + i, [float("nan"), 1.0, 1.0, 1.0]) for i in range(30)] + [(3000, None), (3001, [float("inf")] * 4)]
    idx = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    q = spark.createDataFrame([(1, [0.0] * 4, 10), (2, [1.0] * 4, 60), (3, [1.0, 0.0, 0.0, 0.0], 5), (4, [float("nan")] * 4, 3), (5, None, 2)],
                              "qid long, qvec array<double>, lim int")
    got = {}
    for x in topk.knn(idx, q, 4, 100, k_col="lim", config=config).collect():
        got.setdefault(x.qid, []).append((x.rank, x.id, x.score))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and np.isfinite(v).all()}
    for qid, vec, k in ((1, np.zeros(4), 10), (2, np.ones(4) / 2, 60), (3, np.array([1.0, 0, 0, 0]), 5)):
        want = sorted(((-round(float(u @ vec), 6) + 0.0, i) for i, u in unit.items()))[:k]
        assert [(n, i) for n, i, _ in sorted(got[qid])] == [(n, i) for n, (_, i) in enumerate(want, 1)]
    assert set(got) == {1, 2, 3}


@pytest.mark.parametrize("config", _kernel_paths())
def test_topk_rejects_bad_queries(spark, config):
    idx = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vector array<double>")
    null = spark.createDataFrame([(1, [1.0, 0.0], None), (2, [1.0, 0.0], 1)], "qid long, qvec array<double>, lim int")
    with pytest.raises(ValueError, match="must not be null"):
        topk.knn(idx, null, 2, 5, k_col="lim", config=config)
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0])], "qid long, qvec array<double>")
    with pytest.raises(ValueError, match="unique"):
        topk.knn(idx, twice, 2, 5, config=config)


def test_kernel_keeps_exactly_k():
    from vecdex.functions.vectors import topk_columns
    ids = np.random.default_rng(2).permutation(5000)
    rows, cols, _ = topk_columns(np.zeros((5000, 3)), ids, 7)
    assert len(rows) == 21 and all(set(ids[rows[cols == c]]) == set(range(7)) for c in range(3))


def test_lists_search_reads_probed_lists_only(spark):
    from vecdex.operators import ivf
    from vecdex.session import scratch_path
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(500, 8)))]
    idx = spark.createDataFrame(rows, "id long, vector array<double>")
    path = scratch_path(spark, "ivf-probe")
    ivf.IVFIndex.build(idx, 8, 16).save(path)
    stored = ivf.IVFIndex.load(spark, path, 8)
    q = spark.createDataFrame([(1, rows[3][1])], "qid long, qvec array<double>")
    sizes = {x.list_id: x.n_c for x in stored.sizes.collect()}
    _, corpus_side = stored.sides(q, 10, nprobe=2)
    seen = corpus_side.groupBy("list_id").count().collect()
    assert len(seen) == 2 and sum(x["count"] for x in seen) == sum(sizes[x.list_id] for x in seen) < 500
    everything = {(x.rank, x.id) for x in stored.search(q, 10, nprobe=16).collect()}
    assert everything == {(x.rank, x.id) for x in topk.knn(idx, q, 8, 10).collect()}


def test_balance_starts_no_job(spark):
    from vecdex.session import balance
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("balance-test", "")
    balance(df)
    assert not status.getJobIdsForGroup("balance-test")
    spark.sparkContext.setJobGroup("", "")


def test_candidates_are_bounded_by_groups(spark):
    """An index of many files is scanned in few tasks; the answer is the same."""
    from vecdex.plans.inspect import plan
    from vecdex.session import scratch_path
    path = scratch_path(spark, "many-files")
    df = spark.range(2000).select("id", F.array(*[F.sin(F.col("id") * (k + 1)).cast("float") for k in range(4)]).alias("vector"))
    df.repartition(60).write.parquet(path)
    index = spark.read.parquet(path)
    q = df.where("id % 50 = 0").select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        few = topk.knn(index, q, 4, 5, config=topk.SearchConfig(candidate_groups=3))
        assert "Coalesce (" in plan(few) and "Coalesce (" not in plan(topk.knn(index, q, 4, 5, config=topk.SearchConfig(candidate_groups=10_000)))
        got = sorted(map(tuple, few.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(map(tuple, topk.knn(df, q, 4, 5).collect()))


def test_scroll_skips_files_by_id(spark):
    """Pages after an id read only files that can hold later ids."""
    from vecdex.session import scratch_path
    rows = spark.range(40_000).select("id", F.concat(F.lit("row "), "id").alias("title"))
    stored = search.write_scrollable(rows.repartition(8), scratch_path(spark, "sorted"))
    spans = [(r.lo, r.hi) for r in stored.groupBy(F.input_file_name()).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()]
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))            # disjoint ranges
    seen, after = [], None
    while True:
        page = search.scroll(stored, F.col("id") % 2 == 0, after, page_size=7000)
        got = [r.id for r in page.collect()]
        seen += got
        if len(got) < 7000:
            break
        after = got[-1]
    assert seen == list(range(0, 40_000, 2))
    late = search.scroll(stored, after=39_000)
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,39000)]" in late._jdf.queryExecution().executedPlan().toString()
    # row groups that the filter's statistics rule out are not read
    late.collect()
    scan = late._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() <= max(hi - lo + 1 for lo, hi in spans)


def test_leaders_hold_little_and_are_exact():
    """The leading rows of many queries over many batches, ties and copies included,
    without holding more than a few times the answer."""
    r = np.random.default_rng(9)
    q = topk.normalize_rows(r.normal(size=(1500, 16)).round(1))
    q[7] = 0.0
    c = topk.normalize_rows(np.repeat(r.normal(size=(5000, 16)).round(1), 2, axis=0))
    c[::9] = c[3]                                               # a ninth are copies
    ids = r.permutation(len(c)).astype(np.int64)
    leaders, most = topk.Leaders(q, 5), 0
    for at in range(0, len(c), 1000):
        leaders.add(ids[at:at + 1000], c[at:at + 1000])
        most = max(most, leaders.held)
    who, got, _ = leaders.result()
    assert most < 4 * len(q) * 5 + 250_000
    score = np.round(c @ q.T, 6) + 0.0
    for n in (0, 7, 8, 700, 1499):
        assert got[who == n].tolist() == ids[np.lexsort((ids, -score[:, n]))[:5]].tolist()


def test_blocks_move_little():
    """Many queries with many answers: few corpus blocks, as each of them repeats the
    candidates; few queries: the corpus is not repeated."""
    qn, cn = topk._blocks(60_000, 250_000, 4, 1, 48, 64, 50)
    assert qn * cn >= 48 and cn <= 6
    qn, cn = topk._blocks(100, 5_000_000, 1, 5, 48, 64, 10)
    assert qn == 1 and cn >= 48
