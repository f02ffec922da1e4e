"""Exact cosine top-k search: K1 (one query), K2 (many queries, per-query
limit), J4 (query x corpus scoring) and K5 (result cap).

Plan shape
----------
Scoring is Q x N x d work. Expressing it as a join of query rows with corpus
rows would materialise every (query, vector) pair as a row, so the pairs are
only ever formed inside a task, as one small matrix product after another, and a
task emits no more than ``k`` candidates per query. ``Leaders`` keeps each query's
``k`` best so far; products in single precision tell which pairs can still be among
them, and those few are scored in double precision, so the answer is exact:

* small query side (rows within ``broadcast_bytes``, and at most ``broadcast_hits``
  answers, counted with a bounded collect): the query matrix is broadcast once per
  executor and the corpus is scanned in place with ``mapInArrow``; no corpus shuffle.
* large query side: queries and corpus are both hashed into blocks, and every pair
  of blocks is one partition, sorted so that its queries come first. The corpus
  rows then stream past them: a task holds one query block and its leaders,
  never a whole side.

Candidates (at most tasks x Q x k rows, with a bound on the tasks that does not
grow with the index) are then ranked by
``row_number() over (partition by qid order by round(score,6) desc, id)``,
which Catalyst turns into a partial + final ``WindowGroupLimit`` around one
shuffle on ``qid``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecdex.functions.vectors import DIM_ERROR, arrow_matrix, finite_rows, normalize_rows, topk_columns

# Per-query cap of the search API (F2); the operators here know no cap.
MAX_K = 50
# Score rounding used for ranking and output (6 decimal places).
SCORE_DECIMALS = 6

_CAND_SCHEMA = "qid long, id long, score double, k int"
# queries and corpus rows of one matrix product, so that it stays in a cache
_QUERIES, _ROWS = 1024, 512
_PAIRS = 50_000                   # pairs scored in double precision at once


@dataclass(frozen=True)
class SearchConfig:
    """Size limits of the scoring plan.

    ``broadcast_bytes`` bounds the float64 query matrix shipped to every executor and
    ``broadcast_hits`` its answers (queries x k), as every task holds that many.
    Past either, blocks of queries and of the corpus meet in pairs; the shuffle
    volume is Q x corpus_blocks + N x query_blocks, so query blocks (with ``k``
    leaders each) are made as large as a task may hold. Row counts override bytes.
    An index of more splits than ``candidate_groups`` (four per core unless given)
    is scanned in that many tasks, so that the candidates shuffled are at most
    groups x queries x k however large the index is; blocks are made for that many
    tasks at least."""
    broadcast_bytes: int = 128 << 20
    broadcast_hits: int = 200_000
    query_block_bytes: int = 128 << 20
    corpus_block_bytes: int = 512 << 20
    query_block_rows: int | None = None
    corpus_block_rows: int | None = None
    candidate_groups: int | None = None

    def block_rows(self, dim: int, k: int) -> tuple[int, int]:
        q = self.query_block_rows or max(1, self.query_block_bytes // (12 * dim + 120 * k))
        c = self.corpus_block_rows or max(1, self.corpus_block_bytes // (8 * dim))
        return q, c


DEFAULT = SearchConfig()


# ---------------------------------------------------------------------------
# numpy helpers
# ---------------------------------------------------------------------------

def _prune(qidx: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """Exactly the first ``k`` per query index by (score desc, id asc)."""
    if len(qidx) == 0:
        return qidx, ids, scores
    order = np.lexsort((ids, -scores, qidx))
    q, i, s = qidx[order], ids[order], scores[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    keep = place < k
    return q[keep], i[keep], s[keep]


class Leaders:
    """The ``k`` leading rows of each query among those added so far: unit queries
    ``qmat``, ranked by (rounded score desc, id asc)."""

    def __init__(self, qmat: np.ndarray, k: int):
        self.q, self.k, self.narrow = qmat, k, qmat.astype(np.float32)
        self.zero = ~qmat.any(axis=1)                 # all their scores are 0
        self.low = np.full(len(qmat), -np.inf)        # scores below cannot lead any more
        # half a place of rounding, and what a product in single precision may be off
        self.error = (qmat.shape[1] + 8) * 6e-8
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, ids: np.ndarray, unit: np.ndarray, who: np.ndarray | None = None) -> None:
        """Offer rows to the queries at the places ``who`` (all of them without)."""
        if self.k <= 0 or not len(ids):
            return
        who = np.arange(len(self.q)) if who is None else who
        if self.zero[who].any():
            first = np.sort(ids)[:self.k]
            none = who[self.zero[who]]
            self._keep(np.repeat(none, len(first)), np.tile(first, len(none)), np.zeros(len(none) * len(first)))
            who = who[~self.zero[who]]
        narrow = unit.astype(np.float32)
        # rows are no longer than 1 unless the caller said so and they are
        slack = 1e-6 + self.error * max(1.0, float(np.linalg.norm(unit, axis=1).max()))
        for a in range(0, len(who), _QUERIES):
            own = who[a:a + _QUERIES]
            fresh = np.isneginf(self.low[own])
            some = min(len(ids), max(_ROWS, 4 * self.k))
            if fresh.any():                           # the first rows give them a bound
                self._first(own[fresh], ids[:some], unit[:some])
                self._few(own[fresh], ids[some:], unit[some:], narrow[some:], slack)
            self._few(own[~fresh], ids, unit, narrow, slack)

    def _first(self, own: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> None:
        step = max(1, 4_000_000 // len(ids))
        for a in range(0, len(own), step):
            mine = own[a:a + step]
            row, column, score = topk_columns(np.round(unit @ self.q[mine].T, SCORE_DECIMALS) + 0.0, ids, self.k)
            self._keep(mine[column], ids[row], score)
            if len(ids) >= self.k:
                least = np.full(len(mine), np.inf)
                np.minimum.at(least, column, score)
                self.low[mine] = np.maximum(self.low[mine], least)

    def _few(self, own: np.ndarray, ids: np.ndarray, unit: np.ndarray, narrow: np.ndarray, slack: float) -> None:
        if not len(own) or not len(ids):
            return
        low, side = (self.low[own] - slack).astype(np.float32) - np.float32(1e-7), self.narrow[own].T
        for b in range(0, len(ids), _ROWS):
            hits = np.flatnonzero(narrow[b:b + _ROWS] @ side >= low)
            for at in range(0, len(hits), _PAIRS):
                row, column = np.divmod(hits[at:at + _PAIRS], len(own))
                score = np.einsum("ij,ij->i", unit[b + row], self.q[own[column]])
                score = np.round(score, SCORE_DECIMALS) + 0.0
                lead = score >= self.low[own[column]]
                self._keep(own[column[lead]], ids[b + row[lead]], score[lead])

    def _keep(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((who, ids, scores))
        self.held += len(who)
        if self.held > 2 * len(self.q) * self.k + 200_000:
            self._cut()

    def _cut(self) -> None:
        """Raise the bounds to each query's k-th score so far; drop what is below."""
        who, ids, scores = (np.concatenate(p) for p in zip(*self.parts))
        places = np.rint(scores * 10 ** SCORE_DECIMALS).astype(np.int64)
        if np.abs(places).max(initial=0) < 1 << 22:   # one number per row: query, then falling score
            order = np.sort((who.astype(np.int64) << 23) + ((1 << 22) - places))
            start = np.searchsorted(order, np.arange(len(self.q) + 1) << 23)
            full = np.flatnonzero(np.diff(start) >= self.k)
            kth = (1 << 22) - (order[start[full] + self.k - 1] & ((1 << 23) - 1))
            self.low[full] = np.maximum(self.low[full], np.round(kth / 10 ** SCORE_DECIMALS, SCORE_DECIMALS))
            lead = scores >= self.low[who]
            who, ids, scores = who[lead], ids[lead], scores[lead]
        if len(who) > 1.5 * len(self.q) * self.k + 100_000:   # many equal scores
            who, ids, scores = _prune(who, ids, scores, self.k)
        self.parts, self.held = [(who, ids, scores)], len(who)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries, ids and scores, exactly the leading ``k`` per query."""
        if not self.parts:
            e = np.zeros(0, dtype=np.int64)
            return e, e, np.zeros(0)
        self._cut()
        return _prune(*self.parts[0], self.k)

    def batches(self, qids: np.ndarray, limits: np.ndarray) -> Iterator[pa.RecordBatch]:
        q, i, s = self.result()
        for a in range(0, len(q), 100_000):
            own = q[a:a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(qids[own], pa.int64()), pa.array(i[a:a + 100_000], pa.int64()),
                 pa.array(s[a:a + 100_000], pa.float64()), pa.array(limits[own], pa.int32())],
                names=["qid", "id", "score", "k"])


def _ranked_rows(rb: pa.RecordBatch, vec_col: str, dim: int, normalized: bool) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows that can be ranked, and their vectors as they are scored. Null vectors
    are skipped here rather than by a Spark filter, so an embedding UDF feeding this
    scan is evaluated only once."""
    if rb.column(vec_col).null_count:
        rb = rb.filter(pc.is_valid(rb.column(vec_col)))
    m = arrow_matrix(rb.column(vec_col), dim)
    ok = finite_rows(m)
    if not ok.all():
        rb, m = rb.filter(pa.array(ok)), m[ok]
    return rb, m if normalized else normalize_rows(m)


def _broadcast_kernel(bq, id_col: str, vec_col: str, dim: int, kmax: int,
                      normalized: bool):
    def run(batches):
        qids, qk, qmat = bq.value
        leaders = Leaders(qmat, kmax)
        for rb in batches:
            rb, m = _ranked_rows(rb, vec_col, dim, normalized)
            leaders.add(rb.column(id_col).to_numpy(zero_copy_only=False).astype(np.int64), m)
        yield from leaders.batches(qids, qk)
    return run


class _Block:
    """Queries of one block and the rows that stream past them. ``lists`` of a query:
    the lists whose rows it meets; without, it meets every row."""

    def __init__(self, dim: int, k: int, normalized: bool):
        self.dim, self.k, self.normalized = dim, k, normalized
        self.asked: list[tuple] = []
        self.leaders: Leaders | None = None

    def ask(self, rb: pa.RecordBatch) -> None:
        rb, unit = _ranked_rows(rb, "vec", self.dim, False)
        lists = rb.column("lists")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        self.asked.append((rb.column("id").to_numpy(), rb.column("k").to_numpy(), unit, sizes,
                           lists.flatten().to_numpy(zero_copy_only=False), lists.null_count < len(lists)))

    def meet(self, rb: pa.RecordBatch) -> None:
        if not self.asked:
            return
        if self.leaders is None:
            self.ids, self.limits, unit, sizes, flat = (np.concatenate(p) for p in list(zip(*self.asked))[:5])
            self.leaders, self.starts = Leaders(unit, self.k), None
            if any(a[5] for a in self.asked):         # queries by list
                order = np.argsort(flat, kind="stable")
                self.members = np.repeat(np.arange(len(sizes)), sizes)[order]
                self.lists, self.starts = np.unique(flat[order], return_index=True)
                self.starts = np.append(self.starts, len(flat))
        rb, unit = _ranked_rows(rb, "vec", self.dim, self.normalized)
        ids = rb.column("id").to_numpy()
        if self.starts is None:
            return self.leaders.add(ids, unit)
        own = rb.column("own").to_numpy()
        for c in np.unique(own):
            at = np.searchsorted(self.lists, c)
            if at < len(self.lists) and self.lists[at] == c:
                here = own == c
                self.leaders.add(ids[here], unit[here], self.members[self.starts[at]:self.starts[at + 1]])

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.leaders is not None:
            yield from self.leaders.batches(self.ids, self.limits)


def _meeting_kernel(dim: int, k: int, normalized: bool):
    def run(batches):
        block, number = _Block(dim, k, normalized), -1
        for rb in batches:
            spots = rb.column("spot").to_numpy() >> 32
            edges = np.r_[0, np.flatnonzero(np.diff(spots)) + 1, len(spots)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if spots[a] >> 1 != number:
                    yield from block.batches()
                    block, number = _Block(dim, k, normalized), spots[a] >> 1
                (block.meet if spots[a] & 1 else block.ask)(rb.slice(a, b - a))
        yield from block.batches()
    return run


def meet(queries: DataFrame, corpus: DataFrame, parts: int, dim: int, k: int, normalized: bool = False) -> DataFrame:
    """Candidates of queries (part, id, k, lists, vec) among the corpus rows (part, id,
    own, vec) of the same part: with ``lists``, only among rows whose ``own`` is one of
    them. The queries of a part are held by one task, its corpus rows stream past."""
    if queries.schema["vec"].dataType != corpus.schema["vec"].dataType:
        queries, corpus = (x.withColumn("vec", F.col("vec").cast("array<double>")) for x in (queries, corpus))

    def spot(kind: int, own):  # order within a part: queries, then rows list by list
        return (F.shiftleft(F.col("part").cast("long") * 2 + kind, 32) + own).alias("spot")

    asked = queries.select("part", spot(0, F.lit(0)), "id", F.col("k").cast("int").alias("k"), F.lit(0).alias("own"), "lists", "vec")
    rows = corpus.select("part", spot(1, F.col("own")), "id", F.lit(0).alias("k"), F.col("own").cast("int").alias("own"),
                         F.lit(None).cast("array<int>").alias("lists"), "vec")
    tasks = min(parts, 16 * queries.sparkSession.sparkContext.defaultParallelism)
    both = asked.unionByName(rows).withColumn("part", F.pmod(F.col("part"), F.lit(tasks)).cast("int"))
    return both.repartitionById(tasks, "part").sortWithinPartitions("spot").mapInArrow(
        _meeting_kernel(dim, k, normalized), _CAND_SCHEMA)


def scan_tasks(df: DataFrame) -> int:
    """Tasks that a scan of stored files will take, from the files' bytes and the
    split size; 1 where the input is no file scan. No job is started."""
    files = df.inputFiles()
    if not files:
        return 1
    conf = df.sparkSession.conf
    split = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, size // max(1, split))


# ---------------------------------------------------------------------------
# public operators
# ---------------------------------------------------------------------------

def _check_queries(null_limits: int, repeated: int) -> None:
    if null_limits:
        raise ValueError("per-query k must not be null")
    if repeated:
        raise ValueError("qid must be unique")


def rank_candidates(cands: DataFrame, kmax: int) -> DataFrame:
    """Final exact ranking of kernel candidates: rank by rounded score desc,
    id asc; keep rank <= kmax (WindowGroupLimit) then rank <= per-query k."""
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    return (cands
            .withColumn("score", F.round("score", SCORE_DECIMALS))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= kmax)
            .where(F.col("rank") <= F.col("k"))
            .select("qid", "rank", "id", "score"))


def _blocks(n_q: int, n_c: int, least_q: int, least_c: int, groups: int, dim: int, k: int) -> tuple[int, int]:
    """Query and corpus blocks, ``groups`` pairs of them at least, so that the least is
    shuffled: corpus rows once per query block, queries and their ``k`` candidates once
    per corpus block."""
    def moved(cn: int) -> int:
        return max(least_q, math.ceil(groups / cn)) * n_c * 4 * dim + cn * n_q * (4 * dim + 28 * k)
    cn = min(range(max(1, least_c), max(1, least_c, groups) + 1), key=moved)
    return max(1, least_q, min(n_q, math.ceil(groups / cn))), cn


def knn(index: DataFrame, queries: DataFrame, dim: int, k: int = 10, *,
        id_col: str = "id", vec_col: str = "vector", qid_col: str = "qid",
        qvec_col: str = "qvec", k_col: str | None = None,
        index_normalized: bool = False, config: SearchConfig = DEFAULT) -> DataFrame:
    """K2: exact cosine top-k for every query row.

    ``queries`` holds (qid, qvec[, k_col]), one row per qid. Limits are those of
    ``k_col`` where it is given (they must not be null) and ``k`` otherwise; the
    operator sets no cap of its own. Vectors that are null or hold a non-finite
    number are not ranked, as index rows or as queries. A qid that stands twice
    raises, on either path. Output: qid, rank, id, score."""
    spark = index.sparkSession
    qk = F.col(k_col).cast("int") if k_col else F.lit(k).cast("int")
    qsel = queries.select(F.col(qid_col).cast("long").alias("qid"),
                          F.col(qvec_col).alias("qvec"), qk.alias("k"))
    csel = index.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    max_rows = max(1, min(config.broadcast_bytes // (8 * dim), config.broadcast_hits // max(k, 1)))
    groups = config.candidate_groups or 4 * spark.sparkContext.defaultParallelism
    # bounded collect: at most max_rows + 1 rows ever reach the driver; the
    # size decision is taken on the raw row count (nulls included) so no
    # query beyond the cap can be lost
    raw = qsel.limit(max_rows + 1).toArrow()
    if raw.num_rows <= max_rows:
        qids = raw.column("qid").to_numpy(zero_copy_only=False)
        _check_queries(raw.column("k").null_count, raw.num_rows - len(np.unique(qids)))
        small = raw.filter(pc.is_valid(raw.column("qvec")))
        vectors = arrow_matrix(small.column("qvec"), dim)
        ok = finite_rows(vectors)
        qids = small.column("qid").to_numpy(zero_copy_only=False).astype(np.int64)[ok]
        ks = small.column("k").to_numpy(zero_copy_only=False).astype(np.int32)[ok]
        if not len(qids):
            return spark.createDataFrame([], "qid long, rank int, id long, score double")
        kmax = int(ks.max())
        bq = spark.sparkContext.broadcast((qids, ks, normalize_rows(vectors[ok])))
        if scan_tasks(csel) > groups:  # a task takes several splits and keeps k rows a query over all of them
            csel = csel.coalesce(groups)
        cands = csel.mapInArrow(
            _broadcast_kernel(bq, "id", "vec", dim, kmax, index_normalized), _CAND_SCHEMA)
        out = rank_candidates(cands, kmax)
        out.rows_bound = int(ks.astype(np.int64).clip(0).sum())
        return out
    seen = qsel.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"),
                    F.sum(F.col("k").isNull().cast("int")).alias("nulls")).first()
    twice = qsel.groupBy("qid").count().where("count > 1").limit(1).count()
    _check_queries(seen["nulls"], twice)
    n_q, kmax = seen["n"], seen["k"]
    n_c = csel.count()
    q_rows, c_rows = config.block_rows(dim, kmax)
    qn, cn = _blocks(n_q, n_c, math.ceil(n_q / q_rows), math.ceil(n_c / c_rows), groups, dim, kmax)
    qb = (qsel.select(F.col("qid").alias("id"), "k", F.lit(None).cast("array<int>").alias("lists"), F.col("qvec").alias("vec"),
                      F.explode(F.sequence(F.lit(0), F.lit(cn - 1))).alias("cb"))
          .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(qn)) * cn + F.col("cb")))
    cb = (csel.select("id", F.lit(0).alias("own"), "vec", F.explode(F.sequence(F.lit(0), F.lit(qn - 1))).alias("qb"))
          .withColumn("part", F.col("qb") * cn + F.pmod(F.xxhash64("id"), F.lit(cn))))
    return rank_candidates(meet(qb, cb, qn * cn, dim, kmax, index_normalized), kmax)


def knn_single(index: DataFrame, qvec, dim: int, k: int = 10, *,
               id_col: str = "id", vec_col: str = "vector",
               index_normalized: bool = False) -> DataFrame:
    """K1 / K5: top-k for one query vector; ``min(k, available)`` rows,
    k = 0 gives no rows. Plan: per-partition Arrow top-k, then
    TakeOrderedAndProject on the rounded score."""
    spark = index.sparkSession
    if k <= 0:
        return spark.createDataFrame([], "rank int, id long, score double")
    qmat = normalize_rows(np.asarray([qvec], dtype=np.float64))
    bq = spark.sparkContext.broadcast((np.zeros(1, dtype=np.int64),
                                       np.full(1, k, dtype=np.int32), qmat))
    csel = index.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    cands = csel.mapInArrow(_broadcast_kernel(bq, "id", "vec", dim, k, index_normalized),
                            _CAND_SCHEMA)
    top = (cands.select("id", F.round("score", SCORE_DECIMALS).alias("score"))
           .orderBy(F.col("score").desc(), F.col("id").asc()).limit(k))
    w = Window.orderBy(F.col("score").desc(), F.col("id").asc())
    # k rows at most: the single-partition window only numbers the final list
    return top.withColumn("rank", F.row_number().over(w)).select("rank", "id", "score")
