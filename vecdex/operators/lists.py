"""Clustered vector lists: approximate search on compressed vectors (K4), exact
search that skips what cannot matter (K1/K2), and payload filters that choose
how much to probe (F5).

Layout of a stored index (one parquet table, sorted by list, so that a filter on
``list_id`` skips row groups): ``list_id, id, dist`` (distance of the unit vector
to its list's centroid), ``code`` (product quantiser, one byte per subspace),
``vec`` (as given) and the payload columns wanted for filters. Beside it lie the
centroids, codebooks, list sizes and radii, payload counts per list and the
settings that ``tune`` measured.

* Centroids have two levels: a vector (or query) meets the group centroids first
  and then only the lists of near groups, so assigning N vectors to L lists costs
  about N * 2 * sqrt(L) distances.
* Training uses a bounded sample (``TRAIN_BYTES`` of vectors, chosen by a hash of
  the id) in one task. Every vector is assigned, coded and stored.
* Approximate search scans ``list_id, id, code`` only. A query's products with the
  codebooks are looked up by code; where many queries meet few rows, rows are
  built from the codebooks instead, which gives the same scores. The best
  ``shortlist`` per query are scored exactly on their full vectors.
* Exact search takes each query's k-th score over its nearest lists as a bound.
  By the triangle inequality a list of radius r and a row at distance t from its
  centroid cannot reach a score above 1 - (D - r)^2 / 2 or 1 - (D - t)^2 / 2,
  with D the query's distance to the centroid; what stays below the bound is
  skipped. The answer is that of ``topk.knn``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.functions.vectors import arrow_matrix, finite_rows, normalize_rows, topk_columns
from vecdex.operators import topk

#: vectors (as float32) of the training sample, at most
TRAIN_BYTES = 64 << 20
#: share of the true neighbours that a tuned index finds at least
RECALL = 0.9
#: queries whose recall ``tune`` measures, those with the smallest hash of their id
TUNE_QUERIES = 1000
#: bytes of the query side that is broadcast; beyond that queries are shuffled
BROADCAST_BYTES = 128 << 20
#: shortlisted rows up to this many are broadcast to the vectors (about 30 bytes each)
BROADCAST_ROWS = 1_000_000
#: probed lists up to this many become a pushed filter of the scan
PUSHED_LISTS = 2000
#: shortlist entries that a task holds at once; more queries are sent in several pieces
HELD_ROWS = 1_000_000
#: scores of one list that are held at once
HELD_SCORES = 4_000_000
#: dimensions of one subspace of the product quantiser
SUBSPACE = 4
_SLACK = 2e-6  # scores are ranked by six places; bounds give way by more than that


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids of at most ``k`` clusters of a sample, by Lloyd's rounds. A cluster
    that runs empty takes the row farthest from its centroid."""
    r = np.random.default_rng(seed)
    x = x.astype(np.float32)
    k = min(k, len(x))
    centres = x[np.sort(r.choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        near, gap = nearest(x, centres)
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres, np.float64)
        np.add.at(sums, near, x)
        empty = np.flatnonzero(count == 0)
        fresh = (sums / np.maximum(count, 1)[:, None]).astype(np.float32)
        if len(empty):
            fresh[empty] = x[np.argsort(-gap, kind="stable")[:len(empty)]]
        if np.array_equal(fresh, centres):
            break
        centres = fresh
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, step: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre and the squared distance, up to the rows' own norm."""
    half = (centres * centres).sum(axis=1) / 2
    where, gap = np.empty(len(x), np.int64), np.empty(len(x))
    for at in range(0, len(x), step):
        score = x[at:at + step] @ centres.T - half
        where[at:at + step] = score.argmax(axis=1)
        gap[at:at + step] = -score.max(axis=1)
    return where, gap


@dataclass
class Quantiser:
    """Two-level centroids and codebooks, all arrays. Lists of a group have
    consecutive numbers, from ``first[group]`` on."""
    groups: np.ndarray      # groups x dim
    first: np.ndarray       # groups + 1
    centres: np.ndarray     # lists x dim
    books: np.ndarray       # subspaces x codes x SUBSPACE (the last subspace is padded)

    @classmethod
    def train(cls, unit: np.ndarray, groups: int, per_group: int) -> "Quantiser":
        top = kmeans(unit, groups)
        own, _ = nearest(unit, top)
        parts = [kmeans(unit[own == g], per_group, seed=g) if (own == g).any() else top[g:g + 1] for g in range(len(top))]
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        out = cls(top.astype(np.float64), first, np.vstack(parts).astype(np.float64), np.zeros((0, 0, SUBSPACE)))
        rest = unit - out.centres[out.assign(unit)]
        books = [kmeans(sub, 256, seed=j) for j, sub in enumerate(out.subspaces(rest))]
        width = max(len(b) for b in books)
        out.books = np.stack([np.pad(b, ((0, width - len(b)), (0, 0)), mode="edge") for b in books]).astype(np.float32)
        return out

    @staticmethod
    def subspaces(x: np.ndarray) -> list[np.ndarray]:
        gap = -x.shape[1] % SUBSPACE
        x = np.pad(x, ((0, 0), (0, gap))) if gap else x
        return [x[:, j:j + SUBSPACE] for j in range(0, x.shape[1], SUBSPACE)]

    def assign(self, unit: np.ndarray) -> np.ndarray:
        group, _ = nearest(unit, self.groups)
        out = np.empty(len(unit), np.int64)
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            out[rows] = self.first[g] + nearest(unit[rows], self.centres[self.first[g]:self.first[g + 1]])[0]
        return out

    def encode(self, unit: np.ndarray, lists: np.ndarray) -> np.ndarray:
        rest = unit - self.centres[lists]
        return np.stack([nearest(sub.astype(np.float32), book)[0] for sub, book in zip(self.subspaces(rest), self.books)],
                        axis=1).astype(np.uint8)

    def scores(self, queries: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Approximate products of queries with the coded rows of one list, rows x queries."""
        base = queries @ self.centres[number]
        if len(queries) * self.books.shape[1] <= len(codes) * 4:  # few queries: look their products up
            out = np.zeros((len(codes), len(queries)), np.float32)
            for j, sub in enumerate(self.subspaces(queries.astype(np.float32))):
                out += (self.books[j] @ sub.T)[codes[:, j]]
        else:  # few rows: build them from the codebooks
            rows = np.concatenate([self.books[j][codes[:, j]] for j in range(codes.shape[1])], axis=1)[:, :queries.shape[1]]
            out = rows @ queries.T.astype(np.float32)
        return out + base

    def order(self, queries: np.ndarray, lists: int) -> np.ndarray:
        """The ``lists`` nearest lists of each query, nearest first. Groups are taken
        in order of distance until they hold twice as many lists."""
        n, total = len(queries), len(self.centres)
        lists = min(lists, total)
        near = np.argsort((self.groups * self.groups).sum(axis=1)[None, :] / 2 - queries @ self.groups.T, axis=1, kind="stable")
        size = np.diff(self.first)
        half = (self.centres * self.centres).sum(axis=1) / 2
        out = np.empty((n, lists), np.int32)
        for at in range(n):
            enough = int(np.searchsorted(np.cumsum(size[near[at]]), min(total, 2 * lists))) + 1
            own = np.concatenate([np.arange(self.first[g], self.first[g + 1]) for g in near[at][:enough]])
            gap = half[own] - self.centres[own] @ queries[at]
            out[at] = own[np.argsort(gap, kind="stable")[:lists]]
        return out

    def rows(self) -> list[tuple]:
        plain = [("group", int(self.first[g]), 0, c.tolist()) for g, c in enumerate(self.groups)]
        plain += [("list", k, 0, c.tolist()) for k, c in enumerate(self.centres)]
        return plain + [("book", j, c, row.astype(float).tolist()) for j, book in enumerate(self.books) for c, row in enumerate(book)]

    @classmethod
    def of_rows(cls, rows: list) -> "Quantiser":
        part = {kind: sorted((r["a"], r["b"], r["v"]) for r in rows if r["kind"] == kind) for kind in ("group", "list", "book")}
        centres = np.array([v for *_, v in part["list"]])
        books = np.array([v for *_, v in part["book"]], np.float32)
        subspaces = part["book"][-1][0] + 1
        return cls(np.array([v for *_, v in part["group"]]), np.array([a for a, *_ in part["group"]] + [len(centres)]), centres,
                   books.reshape(subspaces, -1, SUBSPACE))


def _unit_rows(batch: pa.RecordBatch, column: str, dim: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows that can be ranked, and their unit vectors."""
    if batch.column(column).null_count:
        batch = batch.filter(pc.is_valid(batch.column(column)))
    m = arrow_matrix(batch.column(column), dim)
    fine = finite_rows(m)
    if not fine.all():
        batch, m = batch.filter(pa.array(fine)), m[fine]
    return batch, normalize_rows(m)


def trained(index: DataFrame, dim: int, groups: int, per_group: int, n: int) -> Quantiser:
    """A quantiser from a sample of at most about ``TRAIN_BYTES`` of vectors."""
    share = min(1.0, TRAIN_BYTES / (4 * dim * max(n, 1)))
    sample = index if share == 1.0 else index.where(F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unit_rows(b, "vec", dim)[1].astype(np.float32) for b in batches]
        unit = np.vstack(parts) if parts else np.zeros((0, dim), np.float32)
        if not len(unit):
            return
        rows = Quantiser.train(unit, groups, per_group).rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64())))],
            ["kind", "a", "b", "v"])

    rows = sample.select("vec").repartition(1).mapInArrow(run, "kind string, a int, b int, v array<double>").collect()
    if not rows:
        raise ValueError("no vector to train lists on")
    return Quantiser.of_rows(rows)


class ListIndex:
    """A stored index of vector lists at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows = spark.read.parquet(path + "/rows")
        meta = json.loads(spark.read.text(path + "/settings").first()[0])
        self.dim, self.nprobe, self.shortlist = meta["dim"], meta.get("nprobe"), meta.get("shortlist")
        self.shares: dict[str, float] = meta.get("shares", {})
        self.payload: list[str] = meta["payload"]
        self.quantiser = Quantiser.of_rows(spark.read.parquet(path + "/quantiser").collect())
        lists = len(self.quantiser.centres)
        self.sizes, self.radius = np.zeros(lists, np.int64), np.zeros(lists)
        for r in spark.read.parquet(path + "/lists").collect():  # one row per list
            self.sizes[r["list_id"]], self.radius[r["list_id"]] = r["n"], r["radius"]
        self.nprobe = self.nprobe or lists
        self.shortlist = self.shortlist or 100

    # -- building ----------------------------------------------------------------
    @classmethod
    def build(cls, index: DataFrame, path: str, dim: int, *, id_col: str = "id", vec_col: str = "vector",
              payload: list[str] | None = None, lists: int | None = None) -> "ListIndex":
        """Train, assign, code and store every vector that can be ranked (null and
        non-finite ones cannot). ``payload`` columns are stored for filters, with
        their counts per list; they should have few values. About sqrt(N) lists
        unless ``lists`` is given."""
        spark, payload = index.sparkSession, list(payload or [])
        plain = index.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), *payload)
        n = plain.count()
        lists = lists or max(1, math.isqrt(n))
        groups = max(1, math.isqrt(lists))
        model = trained(plain, dim, groups, -(-lists // groups), n)
        shared = spark.sparkContext.broadcast(model)
        schema = T.StructType([T.StructField("list_id", T.IntegerType()), T.StructField("dist", T.DoubleType()),
                               T.StructField("code", T.BinaryType()), *plain.schema.fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for whole in batches:
                batch, unit = _unit_rows(whole, "vec", dim)
                if not batch.num_rows:
                    continue
                own = q.assign(unit)
                codes = q.encode(unit, own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array(np.linalg.norm(unit - q.centres[own], axis=1)),
                     pa.array([c.tobytes() for c in codes], pa.binary()), *batch.columns], schema.names)

        # a list with a third of the rows is cut over several files by the id
        coded = plain.mapInArrow(run, schema)
        coded.repartitionByRange("list_id", "id").sortWithinPartitions("list_id", "id").write.mode("overwrite").parquet(path + "/rows")
        rows = spark.read.parquet(path + "/rows")
        (rows.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius"))
         .coalesce(1).write.mode("overwrite").parquet(path + "/lists"))
        if payload:
            counts = [rows.groupBy("list_id", F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
                      .withColumn("name", F.lit(c)) for c in payload]
            every = counts[0]
            for c in counts[1:]:
                every = every.unionByName(c)
            every.write.mode("overwrite").partitionBy("name").parquet(path + "/payload")
        spark.createDataFrame(model.rows(), "kind string, a int, b int, v array<double>").coalesce(1).write.mode("overwrite").parquet(path + "/quantiser")
        cls._settings(spark, path, {"dim": dim, "payload": payload})
        return cls(spark, path)

    @staticmethod
    def _settings(spark: SparkSession, path: str, values: dict) -> None:
        spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(path + "/settings")

    def tune(self, queries: DataFrame, k: int = 10, recall: float = RECALL, *, qid_col: str = "qid", qvec_col: str = "qvec",
             depths: tuple[int, ...] = (10, 100)) -> "ListIndex":
        """Measure, against the exact answers of ``TUNE_QUERIES`` queries, how many
        lists and how long a shortlist give the recall wanted by two standard
        errors, and store them. ``depths``: for filters that keep one row in so
        many, the share of the rows to probe, from the exact answers that much
        deeper."""
        few = (queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).alias("qvec")).where(F.col("qvec").isNotNull())
               .orderBy(F.xxhash64("qid"), "qid").limit(TUNE_QUERIES))
        few = self.spark.createDataFrame(few.collect(), few.schema)  # a bounded number of rows
        own = self.rows.select("id", "vec", "list_id")
        deepest = k * max(depths, default=1)
        exact = topk.knn(own, few, self.dim, min(deepest, int(self.sizes.sum())), vec_col="vec")
        truth = exact.join(own.select("id", "list_id"), "id").select("qid", "rank", "id", "list_id").toPandas()
        sent = self._queries(few, k, len(self.quantiser.centres))
        place = {(int(q), int(c)): at for q, own_lists in zip(sent.ids, sent.lists) for at, c in enumerate(own_lists)}
        rows_before = {int(q): np.cumsum(self.sizes[own_lists]) for q, own_lists in zip(sent.ids, sent.lists)}
        truth["place"] = [place[q, c] for q, c in zip(truth["qid"], truth["list_id"])]
        truth["share"] = [rows_before[q][p] / self.sizes.sum() for q, p in zip(truth["qid"], truth["place"])]
        first = truth[truth["rank"] <= k]
        if not len(first):
            return self
        wanted = _lifted((1 + recall) / 2, len(first))
        self.nprobe = int(np.quantile(first["place"], wanted, method="higher")) + 1
        self.shares = {"1": self.nprobe / len(self.sizes)}
        for d in depths:
            here = truth[truth["rank"] <= k * d]
            self.shares[str(d)] = float(np.quantile(here["share"], wanted, method="higher"))
        # where the true neighbours stand among the approximate scores
        total = int(self.sizes.sum())
        length = 16 * k
        while True:
            got = self._shortlist(sent.cut(self.nprobe), min(length, total)).select("qid", "id", "place").toPandas()
            found = first.merge(got, on=["qid", "id"])
            reached = len(found) / len(first)
            if reached >= _lifted(recall, len(first)) or length >= total:
                break
            length *= 4
        need = math.ceil(_lifted(recall, len(first)) * len(first))
        places = np.sort(found["place_y"] if "place_y" in found else found["place"])
        self.shortlist = int(max(k, places[min(need, len(places)) - 1]))
        self._settings(self.spark, self.path, {"dim": self.dim, "payload": self.payload, "nprobe": self.nprobe,
                                               "shortlist": self.shortlist, "shares": self.shares})
        return self

    # -- queries -------------------------------------------------------------------
    def _queries(self, queries: DataFrame, k: int, lists: int) -> "_Sent":
        rows = queries.select(F.col("qid").cast("long"), "qvec").toArrow()
        return _Sent.of(rows, k, self.dim, self.quantiser, lists)

    def search(self, queries: DataFrame, k: int = 10, *, nprobe: int | None = None, shortlist: int | None = None,
               where: dict[str, object] | None = None, qid_col: str = "qid", qvec_col: str = "qvec") -> DataFrame:
        """Approximate top ``k``: qid, rank, id, score (exact scores). ``where`` maps
        payload columns to the values wanted; the counts per list then choose how
        many lists to probe, and lists without such rows cost nothing."""
        plain = queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).alias("qvec"))
        nprobe, shortlist = min(nprobe or self.nprobe, len(self.sizes)), max(k, shortlist or self.shortlist)
        weight = self._weights(where) if where else None
        limit = max(1, BROADCAST_BYTES // (8 * self.dim + 8 * len(self.sizes)))
        raw = plain.limit(limit + 1).toArrow()
        if raw.num_rows > limit:
            return self._search_shuffled(plain, k, nprobe, shortlist, where)
        sent = _Sent.of(raw, k, self.dim, self.quantiser, len(self.sizes) if where else nprobe)
        if where:
            sent = sent.reach(weight, self._share(weight, k))
        short = self._shortlist(sent, shortlist, where)
        return self._ranked(short, sent, k, shortlist)

    def _weights(self, where: dict) -> np.ndarray:
        """Rows per list that can match: the least of the counts of each condition."""
        out = self.sizes.copy()
        counts = self.spark.read.parquet(self.path + "/payload")
        for name, value in where.items():
            mine = np.zeros(len(out), np.int64)
            same = F.col("value").eqNullSafe(F.lit(value).cast("string"))
            for r in counts.where((F.col("name") == name) & same).collect():  # one row per list at most
                mine[r["list_id"]] = r["n"]
            out = np.minimum(out, mine)
        return out

    def _share(self, weight: np.ndarray, k: int) -> float:
        """The share of matching rows to probe, from the depths measured: the rarer
        the matches, the deeper among all rows the k-th of them lies."""
        rare = self.sizes.sum() / max(weight.sum(), 1)
        known = sorted((int(d), s) for d, s in self.shares.items())
        if not known or rare > known[-1][0] * 1.5:
            return 1.0
        return float(np.interp(math.log(rare), [math.log(d) for d, _ in known], [s for _, s in known]))

    def _scan(self, lists: np.ndarray, columns: list[str], where: dict | None = None) -> DataFrame:
        rows = self.rows
        for name, value in (where or {}).items():
            rows = rows.where(F.col(name).eqNullSafe(F.lit(value)) if value is None else F.col(name) == F.lit(value))
        if len(lists) < len(self.sizes) and len(lists) <= PUSHED_LISTS:  # row groups hold few lists each
            rows = rows.where(F.col("list_id").isin([int(c) for c in lists]))
        return rows.select(*columns)

    def _shortlist(self, sent: "_Sent", length: int, where: dict | None = None) -> DataFrame:
        """``qid, id, approx, place``: the best ``length`` of each query's lists by
        approximate score. A task holds a shortlist for every query it is sent, so
        many queries are sent in pieces."""
        step = max(1, HELD_ROWS // max(length, 1))
        pieces = [self._candidates(sent.part(at, at + step), length, where) for at in range(0, max(len(sent.ids), 1), step)]
        found = pieces[0]
        for piece in pieces[1:]:
            found = found.unionByName(piece)
        w = Window.partitionBy("qid").orderBy(F.col("approx").desc(), "id")
        return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= length)

    def _candidates(self, sent: "_Sent", length: int, where: dict | None) -> DataFrame:
        data = self.spark.sparkContext.broadcast((sent.ids, sent.vectors, *sent.by_list(len(self.sizes)), self.quantiser))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, vectors, starts, members, q = data.value
            best = _Best(length)
            for batch in batches:
                lists = batch.column(0).to_numpy()
                rows = batch.column(1).to_numpy()
                codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(lists), -1)
                for c in np.unique(lists):
                    who = members[starts[c]:starts[c + 1]]
                    here = np.flatnonzero(lists == c)
                    step = max(1, HELD_SCORES // len(here))
                    for at in range(0, len(who), step):
                        mine = who[at:at + step]
                        best.add(mine, rows[here], q.scores(vectors[mine], int(c), codes[here]))
            yield from best.batches(ids)

        return self._scan(sent.probed(), ["list_id", "id", "code"], where).mapInArrow(run, "qid long, id long, approx double")

    def _ranked(self, short: DataFrame, sent: "_Sent", k: int, length: int) -> DataFrame:
        """Exact scores of the shortlisted rows, ranked as ``topk.knn`` ranks."""
        data = self.spark.sparkContext.broadcast((sent.ids, sent.vectors))
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, vectors = data.value
            order = np.argsort(ids)
            for batch in batches:
                if batch.num_rows:
                    qid = batch.column(0).to_numpy()
                    unit = normalize_rows(arrow_matrix(batch.column(2), dim))
                    score = np.einsum("ij,ij->i", unit, vectors[order[np.searchsorted(ids[order], qid)]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(np.round(score, topk.SCORE_DECIMALS) + 0.0),
                         pa.array(np.full(len(qid), k, np.int32))], ["qid", "id", "score", "k"])

        side = short.select("qid", "id")
        if len(sent.ids) * length <= BROADCAST_ROWS:
            side = F.broadcast(side)
        scored = self._scan(sent.probed(), ["id", "vec"]).join(side, "id").select("qid", "id", "vec").mapInArrow(run, topk._CAND_SCHEMA)
        return topk.rank_candidates(scored, k)

    def _search_shuffled(self, queries: DataFrame, k: int, nprobe: int, shortlist: int, where: dict | None) -> DataFrame:
        """The same for a query side that is too large to broadcast: queries go to
        the lists they probe, in blocks, and meet the codes there."""
        dim, model = self.dim, self.spark.sparkContext.broadcast(self.quantiser)
        lists = len(self.sizes) if where else nprobe
        weight = self._weights(where) if where else None
        share = self._share(weight, k) if where else 0.0
        shape = T.StructType([T.StructField("qid", T.LongType()), T.StructField("lists", T.ArrayType(T.IntegerType())),
                              T.StructField("unit", T.ArrayType(T.DoubleType()))])

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sent = _Sent.of(pa.Table.from_batches([batch]), k, dim, model.value, lists)
                if where:
                    sent = sent.reach(weight, share)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sent.ids), pa.array([c[c >= 0] for c in sent.lists], pa.list_(pa.int32())),
                     pa.array(list(sent.vectors), pa.list_(pa.float64()))], shape.names)

        from vecdex.session import cut_lineage
        probes = cut_lineage(queries.mapInArrow(probe, shape))
        met = probes.select("qid", "unit", F.explode("lists").alias("list_id"))
        rows = self._scan(np.arange(len(self.sizes)), ["list_id", "id", "code"], where)
        blocks = F.broadcast(met.groupBy("list_id").agg(F.count(F.lit(1)).alias("n_q")).join(
            self.spark.read.parquet(self.path + "/lists"), "list_id").select(
            "list_id", F.ceil(F.col("n") / 200_000).cast("int").alias("cs"), F.ceil(F.col("n_q") / 4096).cast("int").alias("qs")))
        left = (met.join(blocks, "list_id").withColumn("qb", F.pmod(F.xxhash64("qid"), "qs"))
                .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cs").cast("long") - 1))).select("list_id", "qb", "cb", "qid", "unit"))
        right = (rows.join(blocks, "list_id").withColumn("cb", F.pmod(F.xxhash64("id"), "cs"))
                 .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qs").cast("long") - 1))).select("list_id", "qb", "cb", "id", "code"))

        def meet(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            best = _Best(shortlist)
            if len(a) and len(b):
                codes = np.frombuffer(b"".join(b["code"]), np.uint8).reshape(len(b), -1)
                best.add(np.arange(len(a)), b["id"].to_numpy(), model.value.scores(np.stack(a["unit"]), int(key[0]), codes))
            parts = [p.to_pandas() for p in best.batches(a["qid"].to_numpy())]
            return pd.concat(parts) if parts else pd.DataFrame({"qid": [], "id": [], "approx": []})

        keys = ["list_id", "qb", "cb"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "qid long, id long, approx double")
        w = Window.partitionBy("qid").orderBy(F.col("approx").desc(), "id")
        short = found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= shortlist).select("qid", "id")
        full = self.rows.select("id", "vec").join(short, "id").join(probes.select("qid", "unit"), "qid")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    unit = normalize_rows(arrow_matrix(batch.column(2), dim))
                    exact = np.einsum("ij,ij->i", unit, arrow_matrix(batch.column(3), dim))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(np.round(exact, topk.SCORE_DECIMALS) + 0.0),
                         pa.array(np.full(len(exact), k, np.int32))], ["qid", "id", "score", "k"])

        return topk.rank_candidates(full.select("qid", "id", "vec", "unit").mapInArrow(score, topk._CAND_SCHEMA), k)

    # -- exact search with pruning ---------------------------------------------------
    def exact(self, queries: DataFrame, k: int = 10, *, qid_col: str = "qid", qvec_col: str = "qvec") -> DataFrame:
        """K1/K2: the exact top ``k``, rows as ``topk.knn`` gives them, without
        scoring the lists and rows that the triangle inequality rules out."""
        plain = queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).alias("qvec"))
        limit = max(1, BROADCAST_BYTES // (8 * self.dim + 16))
        raw = plain.limit(limit + 1).toArrow()
        if raw.num_rows > limit:  # as many queries reach every list
            return topk.knn(self.rows, plain, self.dim, k, vec_col="vec")
        sent, bound = self._bounds(raw, k)
        return topk.rank_candidates(self._pruned(sent, bound, k), k)

    def pairs_scored(self, queries: DataFrame, k: int = 10) -> int:
        """How many (query, row) pairs the second scan of ``exact`` scores."""
        sent, bound = self._bounds(queries.select(F.col("qid").cast("long"), "qvec").toArrow(), k)
        return self._pruned(sent, bound, k, count=True).agg(F.sum("id")).first()[0] or 0

    def _bounds(self, raw: pa.Table, k: int) -> tuple["_Sent", np.ndarray]:
        """Each query's k-th score over its nearest lists that hold k rows."""
        near = 8
        while True:  # as many lists as hold k rows for every query
            sent = _Sent.of(raw, k, self.dim, self.quantiser, near)
            if near >= len(self.sizes) or not len(sent.ids) or self.sizes[sent.lists].sum(axis=1).min() >= k:
                break
            near *= 4
        before = np.cumsum(self.sizes[sent.lists], axis=1) - self.sizes[sent.lists] if len(sent.ids) else np.zeros((0, 1))
        sent.lists = np.where(before < k, sent.lists, -1)
        seeds = self._pruned(sent, np.full(len(sent.ids), -np.inf), k, only=True)
        kth = topk.rank_candidates(seeds, k).where(F.col("rank") == k).select("qid", "score").toPandas()  # a row per query
        bound = pd.Series(kth["score"].to_numpy(), index=kth["qid"].to_numpy()).reindex(sent.ids).fillna(-np.inf).to_numpy()
        return sent, bound

    def _pruned(self, sent: "_Sent", bound: np.ndarray, k: int, *, only: bool = False, count: bool = False) -> DataFrame:
        """Candidates of the lists that can reach the bounds (``only``: of the seed
        lists), or the number of scored pairs of each list."""
        starts, members = sent.by_list(len(self.sizes)) if only else (None, None)
        data = self.spark.sparkContext.broadcast((sent.ids, sent.vectors, bound, starts, members, self.quantiser.centres, self.radius))
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, vectors, low, first, who_of, centres, radius = data.value
            reach = np.sqrt(np.maximum(2 * (1 - low + _SLACK), 0))  # no row farther than this matters
            best, pairs = topk.Leaders(vectors, k), 0
            best.low = low.copy()
            norms = (vectors * vectors).sum(axis=1)
            for batch in batches:
                lists, rows, dist = (batch.column(j).to_numpy() for j in range(3))
                for c in np.unique(lists):
                    here = np.flatnonzero(lists == c)
                    if only:
                        who = who_of[first[c]:first[c + 1]]
                    else:
                        away = np.sqrt(np.maximum(norms + centres[c] @ centres[c] - 2 * (vectors @ centres[c]), 0))
                        who = np.flatnonzero(away - radius[c] <= reach + _SLACK)
                        if len(who):  # and of its rows those at a distance some query can reach
                            near, far = (away[who] - reach[who]).min() - _SLACK, (away[who] + reach[who]).max() + _SLACK
                            here = here[(dist[here] >= near) & (dist[here] <= far)]
                    if not len(who) or not len(here):
                        continue
                    pairs += len(who) * len(here)
                    if count:
                        continue
                    best.add(rows[here], normalize_rows(arrow_matrix(batch.column(3).take(pa.array(here)), dim)), who)
            if count:
                yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([pairs]), pa.array([0.0]), pa.array([0], pa.int32())], ["qid", "id", "score", "k"])
            else:
                yield from best.batches(ids, np.full(len(ids), k, np.int32))

        probed = sent.probed() if only else self._reachable(sent, bound)
        return self._scan(probed, ["list_id", "id", "dist", "vec"]).mapInArrow(run, topk._CAND_SCHEMA)

    def _reachable(self, sent: "_Sent", bound: np.ndarray) -> np.ndarray:
        """Lists that some query can reach; the scan skips the others' row groups."""
        reach = np.sqrt(np.maximum(2 * (1 - bound + _SLACK), 0))
        return np.array([c for c, centre in enumerate(self.quantiser.centres)
                         if (np.linalg.norm(sent.vectors - centre, axis=1) - self.radius[c] <= reach + _SLACK).any()], np.int64)


def _lifted(share: float, n: int) -> float:
    """A share to ask of ``n`` measured cases, so that it holds beyond them."""
    return min(1.0, share + 2 * math.sqrt(share * (1 - share) / n))


@dataclass
class _Sent:
    """Queries on the driver: ids, unit vectors and the lists of each, nearest
    first (-1: not probed). Bounded by the callers."""
    ids: np.ndarray
    vectors: np.ndarray
    lists: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table, k: int, dim: int, q: Quantiser, lists: int) -> "_Sent":
        rows = rows.filter(pc.is_valid(rows.column("qvec")))
        ids = rows.column("qid").to_numpy()
        if len(np.unique(ids)) < len(ids):
            raise ValueError("qid must be unique")
        m = arrow_matrix(rows.column("qvec"), dim)
        fine = finite_rows(m)
        unit = normalize_rows(m[fine])
        return cls(ids[fine], unit, q.order(unit, lists))

    def cut(self, lists: int) -> "_Sent":
        return _Sent(self.ids, self.vectors, self.lists[:, :lists])

    def part(self, a: int, b: int) -> "_Sent":
        return _Sent(self.ids[a:b], self.vectors[a:b], self.lists[a:b])

    def reach(self, weight: np.ndarray, share: float) -> "_Sent":
        """Only lists with matching rows, up to the share of all of them."""
        own = weight[self.lists]
        before = np.cumsum(own, axis=1) - own
        return _Sent(self.ids, self.vectors, np.where((own > 0) & (before < share * weight.sum()), self.lists, -1))

    def probed(self) -> np.ndarray:
        return np.unique(self.lists[self.lists >= 0])

    def by_list(self, lists: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the queries that probe each list: ``members[starts[c]:starts[c + 1]]``."""
        flat = self.lists.ravel()
        who = np.repeat(np.arange(len(self.ids)), self.lists.shape[1] if self.lists.ndim > 1 else 0)[flat >= 0]
        flat = flat[flat >= 0]
        order = np.argsort(flat, kind="stable")
        return np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=lists))]), who[order]


class _Best:
    """The best rows per query seen by one task, cut to ``k`` now and then."""

    def __init__(self, k: int):
        self.k, self.parts, self.held, self.queries = k, [], 0, 0

    def add(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        row, column, score = topk_columns(scores, ids, self.k)
        self.parts.append((who[column], ids[row], score))
        self.held, self.queries = self.held + len(row), max(self.queries, int(who.max(initial=0)) + 1)
        if self.held > 2 * self.queries * self.k + 200_000:
            self.cut()

    def cut(self) -> None:
        self.parts = [topk._prune(*(np.concatenate(p) for p in zip(*self.parts)), self.k)]
        self.held = len(self.parts[0][0])

    def batches(self, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.cut()
            who, row, score = self.parts[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(row), pa.array(score.astype(np.float64))], ["qid", "id", "approx"])
