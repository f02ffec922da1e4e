"""Vector lists: compressed search with measured recall, exact search with
pruning, payload counts that choose the lists of a filtered search."""

import math

import numpy as np
import pytest
from conftest import SF_ORACLE
from pyspark.sql import functions as F

from vecdex.operators import ivf, lists, topk
from vecdex.plans import extra
from vecdex.session import scratch_path
from vecdex.sources.tables import embeddings_index

DIM = 24


def clustered(spark, n=3000, spread=0.15, clusters=40, seed=1):
    """Vectors around random centres; ``tag`` is rare and tied to a few clusters, ``rare`` is not."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, DIM))
    own = r.integers(0, clusters, n)
    own[: n // 3] = 0                                    # one cluster holds a third of the rows
    v = centres[own] + spread * r.normal(size=(n, DIM))
    rows = [(i, [float(x) for x in v[i]], "a" if own[i] == 3 else "b", "x" if i % 100 == 7 else "y") for i in range(n)]
    return spark.createDataFrame(rows, "id long, vector array<float>, tag string, rare string").repartition(6)


@pytest.fixture(scope="module")
def data(spark):
    df = clustered(spark).cache()
    idx = lists.ListIndex.build(df, scratch_path(spark, "lists"), DIM, payload=["tag", "rare"])
    q = df.where("id % 50 = 0").select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    return df, idx.tune(q), q


def ranked(df):
    return sorted((r.qid, r["rank"], r.id, round(r.score, 6)) for r in df.collect())


def test_every_row_is_stored_once(data):
    df, idx, _ = data
    assert sorted(r.id for r in idx.rows.select("id").collect()) == list(range(3000))
    assert idx.sizes.sum() == 3000 and len(idx.sizes) <= 60
    far = idx.rows.groupBy("list_id").agg(F.max("dist").alias("d")).collect()
    assert all(abs(idx.radius[r.list_id] - r.d) < 1e-12 for r in far)


def test_compressed_search_recall(spark, data):
    df, idx, q = data
    exact = topk.knn(df, q, DIM, 10)
    got = idx.search(q, 10)
    assert ivf.recall_at_k(got, exact).first()["recall"] >= 0.9
    assert idx.nprobe < len(idx.sizes) / 2 and idx.shortlist < 500
    other = df.where("id % 50 = 1").select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))  # not measured
    assert ivf.recall_at_k(idx.search(other, 10), topk.knn(df, other, DIM, 10)).first()["recall"] >= 0.9
    scores = {(r.qid, r.id): r.score for r in exact.collect()}
    assert all(abs(scores[r.qid, r.id] - r.score) < 1e-6 for r in got.collect() if (r.qid, r.id) in scores)
    again = lists.ListIndex(spark, idx.path)
    assert (again.nprobe, again.shortlist) == (idx.nprobe, idx.shortlist)


def test_compressed_search_of_everything_is_exact(data):
    df, idx, q = data
    assert ranked(idx.search(q, 10, nprobe=len(idx.sizes), shortlist=3000)) == ranked(topk.knn(df, q, DIM, 10))


def test_large_query_sides_are_shuffled(data, monkeypatch):
    df, idx, q = data
    want, filtered = ranked(idx.search(q, 10)), ranked(idx.search(q, 10, where={"rare": "x"}))
    monkeypatch.setattr(lists, "BROADCAST_BYTES", 1)
    assert ranked(idx.search(q, 10)) == want
    assert ranked(idx.search(q, 10, where={"rare": "x"})) == filtered
    assert ranked(idx.exact(q, 10)) == ranked(topk.knn(df, q, DIM, 10))


@pytest.mark.parametrize("where", [{"rare": "x"}, {"tag": "a"}, {"tag": "a", "rare": "x"}, {"tag": "nowhere"}])
def test_filtered_search_recall(data, where):
    """A filter of 1 %, one tied to few clusters, both, and one without rows."""
    df, idx, q = data
    kept = df
    for name, value in where.items():
        kept = kept.where(F.col(name) == value)
    exact, got = topk.knn(kept, q, DIM, 10), idx.search(q, 10, where=where)
    assert exact.count() == 0 or ivf.recall_at_k(got, exact).first()["recall"] >= 0.9
    assert set(got.select("id").distinct().collect()) <= set(kept.select("id").collect())
    sent = lists._Sent.of(q.toArrow(), 10, DIM, idx.quantiser, len(idx.sizes))
    weight = idx._weights(where)
    assert not set(sent.reach(weight, 1.0).probed()) - set(np.flatnonzero(weight))
    if where == {"tag": "a"}:  # lists without such rows are not probed
        assert len(sent.reach(weight, 1.0).probed()) < len(idx.sizes) / 4


def test_exact_search_prunes(data):
    df, idx, q = data
    for k in (1, 10, 400):
        assert ranked(idx.exact(q, k)) == ranked(topk.knn(df, q, DIM, k))
    assert idx.pairs_scored(q, 10) < 0.55 * 60 * 3000       # a third of the rows is one cluster
    few = q.where("qid >= 1000")                             # away from it
    assert idx.pairs_scored(few, 10) < 0.35 * few.count() * 3000
    assert ranked(idx.exact(q, 4000)) == ranked(topk.knn(df, q, DIM, 4000))


def test_exact_search_on_embeddings(spark):
    idx = extra.vector_lists(spark, SF_ORACLE)
    e = embeddings_index(spark, SF_ORACLE)
    q = e.select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    assert ranked(idx.exact(q, 10)) == ranked(topk.knn(e, q, 64, 10))


@pytest.mark.parametrize("key", ["k4_lists_topk", "f5_lists_topk"])
def test_registered_recall(spark, key):
    e = embeddings_index(spark, SF_ORACLE)
    if key.startswith("f5"):
        from vecdex.sources.tables import table
        e = e.join(table(spark, SF_ORACLE, "documents").where("lang = 'de'").select(F.col("doc_id").alias("id")), "id", "left_semi")
    q = embeddings_index(spark, SF_ORACLE).where("id % 50 = 0").select(F.col("id").alias("qid"), F.col("vector").alias("qvec"))
    got = getattr(extra, key)(spark, SF_ORACLE)
    assert ivf.recall_at_k(got, topk.knn(e, q, 64, 10)).first()["recall"] >= 0.9


def test_edge_rows(spark):
    """Null, non-finite and zero vectors, repeated vectors, fewer rows than k, clashing names."""
    rows = [(1, [1.0, 0.0, 0.0], 5, None), (2, [1.0, 0.0, 0.0], 5, "p"), (3, None, 5, "p"), (4, [float("nan"), 0.0, 0.0], 5, "p"),
            (5, [0.0, 0.0, 0.0], 5, "p"), (6, [0.0, 1.0, 0.5], 5, "")]
    df = spark.createDataFrame(rows, "id long, vector array<float>, qid int, lang string")
    idx = lists.ListIndex.build(df, scratch_path(spark, "edge"), 3, payload=["lang"])
    q = spark.createDataFrame([(9, [1.0, 0.1, 0.0]), (8, None), (7, [0.0, 0.0, 0.0])], "qid long, qvec array<float>")
    want = ranked(topk.knn(df, q, 3, 10))
    assert ranked(idx.exact(q, 10)) == want == ranked(idx.search(q, 10))
    assert [r.id for r in idx.search(q.limit(1), 10, where={"lang": None}).collect()] == [1]
    assert [r.id for r in idx.search(q.limit(1), 10, where={"lang": ""}).collect()] == [6]
    with pytest.raises(Exception, match="unique"):
        idx.search(q.unionByName(q), 10)
    with pytest.raises(Exception, match="no vector"):
        lists.ListIndex.build(df.limit(0), scratch_path(spark, "none"), 3)


def test_quantiser_scores_agree():
    """Looked-up products and rows built from the codebooks are the same scores."""
    r = np.random.default_rng(2)
    unit = lists.normalize_rows(r.normal(size=(900, 10)))
    q = lists.Quantiser.train(unit.astype(np.float32), 4, 5)
    own = q.assign(unit)
    codes = q.encode(unit, own)
    c = int(np.bincount(own).argmax())
    rows = np.flatnonzero(own == c)
    many, few = r.normal(size=(400, 10)), r.normal(size=(1, 10))
    both = np.vstack([few, many])
    assert np.allclose(q.scores(both, c, codes[rows])[:, :1], q.scores(few, c, np.tile(codes[rows], (70, 1)))[:len(rows)], atol=1e-5)
    assert np.abs(q.scores(both, c, codes[rows]) - unit[rows] @ both.T).mean() < 0.3
    back = lists.Quantiser.of_rows([dict(zip(("kind", "a", "b", "v"), row)) for row in q.rows()])
    assert np.array_equal(back.first, q.first) and np.allclose(back.books, q.books) and np.allclose(back.centres, q.centres)
    order = q.order(many, len(q.centres))
    assert all(sorted(o) == list(range(len(q.centres))) for o in order)
    assert math.isclose(lists._lifted(0.9, 10 ** 9), 0.9, abs_tol=1e-4)


def test_many_queries_are_sent_in_pieces(data, monkeypatch):
    df, idx, q = data
    want = ranked(idx.search(q, 10))
    monkeypatch.setattr(lists, "HELD_ROWS", 20 * idx.shortlist)
    monkeypatch.setattr(lists, "HELD_SCORES", 100)
    found = idx.search(q, 10)
    assert ranked(found) == want
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") > 3
