"""K4: approximate top-k with an inverted-file (IVF) index.

* Train: k-means (pyspark.ml, distributed and iterative) on unit vectors;
  the centroids are a small model (lists x dim) kept on the driver.
* Assign: every corpus row gets its nearest centroid (``list_id``),
  computed by the model's JVM transform; no row is dropped.
* Probe: each query meets the centroids (a small model, broadcast) and keeps its
  ``nprobe`` best lists; a row-wise map, no shuffle.
* Score: lists are dealt into groups of about equal size, and a query travels once
  to each group where it probes a list, with the lists it probes there. Queries and
  corpus rows meet per (list group, corpus block, query block); a group of many rows
  is split into blocks of ``corpus_block_rows``, queries into blocks of
  ``query_block_rows``. A task holds one block of queries, its rows stream past.

``nprobe = lists`` scores every vector and equals exact K2. Below that,
``tune`` measures how many lists a search must probe for the recall wanted; an
index that was not tuned probes every list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.functions.vectors import l2_normalize, normalize_rows
from vecdex.operators import topk
from vecdex.session import committed, cut_lineage

# share of the true neighbours a tuned index finds at least
RECALL = 0.9


class IVFIndex:
    def __init__(self, assigned: DataFrame, centroids: np.ndarray, dim: int,
                 sizes: DataFrame | None = None, nprobe: int | None = None):
        self.assigned, self.centroids, self.dim = assigned, centroids, dim
        self.nprobe = nprobe or len(centroids)
        # rows per list: stored with a saved index, counted otherwise
        self.sizes = sizes if sizes is not None else assigned.groupBy("list_id").agg(F.count(F.lit(1)).alias("n_c"))

    @classmethod
    def build(cls, index: DataFrame, dim: int, lists: int, *, id_col: str = "id",
              vec_col: str = "vector", seed: int = 42, max_iter: int = 20) -> "IVFIndex":
        """Train the lists on every vector (k-means is distributed; only
        centroids reach the driver) and assign every vector to its list."""
        unit = index.select(F.col(id_col).cast("long").alias("id"),
                            F.col(vec_col).alias("vec")).where(F.col("vec").isNotNull())
        feats = unit.withColumn("features", array_to_vector(l2_normalize("vec")))
        model = KMeans(k=lists, seed=seed, maxIter=max_iter, featuresCol="features",
                       predictionCol="list_id").fit(feats)
        cents = np.asarray(model.clusterCenters(), dtype=np.float64)
        assigned = (model.transform(feats).select("id", "vec", F.col("list_id").cast("int")))
        return cls(assigned, cents, dim)

    def save(self, path: str) -> None:
        """Lists as a parquet table partitioned by ``list_id`` (a search that
        probes few lists reads only their folders: the join on list_id gets
        dynamic partition pruning) plus the centroid table."""
        spark = self.assigned.sparkSession
        self.assigned.write.mode("overwrite").partitionBy("list_id").parquet(path + "/lists")
        (spark.read.parquet(path + "/lists").groupBy(F.col("list_id").cast("int").alias("list_id"))
         .agg(F.count(F.lit(1)).alias("n_c")).coalesce(1).write.mode("overwrite").parquet(path + "/sizes"))
        self.centroid_table(spark).write.mode("overwrite").parquet(path + "/centroids")
        (spark.range(1).select(F.lit(self.nprobe).alias("nprobe")).coalesce(1)
         .write.mode("overwrite").parquet(path + "/nprobe"))

    @classmethod
    def load(cls, spark, path: str, dim: int) -> "IVFIndex":
        """Re-open a saved index; the centroids (lists x dim) reach the driver."""
        cents = spark.read.parquet(path + "/centroids").orderBy("id").collect()
        assigned = spark.read.parquet(path + "/lists").select(
            "id", "vec", F.col("list_id").cast("int"))
        nprobe = (spark.read.parquet(path + "/nprobe").first()["nprobe"]
                  if committed(spark, path + "/nprobe") else None)
        return cls(assigned, np.asarray([c["vector"] for c in cents], dtype=np.float64), dim,
                   spark.read.parquet(path + "/sizes"), nprobe)

    def centroid_table(self, spark) -> DataFrame:
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.centroids)]
        return spark.createDataFrame(rows, "id long, vector array<double>")

    def recall_curve(self, queries: DataFrame, exact: DataFrame, *, qid_col: str = "qid",
                     qvec_col: str = "qvec") -> tuple[list[float], int]:
        """Recall against the ``exact`` hits of ``queries`` for ``nprobe`` = 1, 2,
        ... up to every list, from one pass: a true neighbour is found exactly
        when its list is probed, so the place of that list among the query's
        lists says from which ``nprobe`` on. At most one count per list reaches
        the driver. The number of exact hits comes with the curve."""
        lists = len(self.centroids)
        exact = cut_lineage(exact.select("qid", "id"))
        places = topk.knn(self.centroid_table(queries.sparkSession), queries, self.dim, lists,
                          qid_col=qid_col, qvec_col=qvec_col)
        found = (exact.join(self.assigned.select("id", "list_id"), "id")
                 .join(places.select("qid", F.col("id").cast("int").alias("list_id"), "rank"), ["qid", "list_id"])
                 .groupBy("rank").agg(F.count(F.lit(1)).alias("n")).collect())
        total, hits = exact.count(), np.zeros(lists)
        for r in found:
            hits[r["rank"] - 1] = r["n"]
        return (hits.cumsum() / max(total, 1)).tolist(), total

    def tune(self, queries: DataFrame, exact: DataFrame, recall: float = RECALL, **columns) -> "IVFIndex":
        """Set ``nprobe`` to the smallest number of lists whose measured recall is
        at least ``recall`` by two standard errors, so that it holds beyond the
        measured queries; every list if none is (or nothing was measured)."""
        curve, n = self.recall_curve(queries, exact, **columns)
        self.nprobe = next((p for p, r in enumerate(curve, 1) if n and r - 2 * math.sqrt(r * (1 - r) / n) >= recall),
                           len(self.centroids))
        return self

    def _probed(self, queries: DataFrame, nprobe: int) -> DataFrame:
        """``qid, qvec, lists``: the ``nprobe`` lists of each query that can be ranked, by
        cosine with the centroids, then by number."""
        dim = self.dim
        shared = queries.sparkSession.sparkContext.broadcast(normalize_rows(self.centroids))
        shape = T.StructType([queries.schema["qid"], queries.schema["qvec"], T.StructField("lists", T.ArrayType(T.IntegerType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 2000):
                    batch, unit = topk._ranked_rows(whole.slice(at, 2000), "qvec", dim, False)
                    if not batch.num_rows:
                        continue
                    score = np.round(unit @ shared.value.T, topk.SCORE_DECIMALS)
                    best = np.argsort(-score, axis=1, kind="stable")[:, :nprobe].astype(np.int32)
                    ends = np.arange(0, best.size + 1, best.shape[1], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, best.ravel())], shape.names)
        return queries.select("qid", "qvec").mapInArrow(run, shape)

    def sides(self, queries: DataFrame, k: int = 10, nprobe: int | None = None, *,
              qid_col: str = "qid", qvec_col: str = "qvec",
              query_block_rows: int = 50_000, corpus_block_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
        """Query rows and corpus rows of the probed lists, by part. Where some lists
        are not probed, the corpus side joins the probed ones on the folder column,
        so a saved index is read for those lists only."""
        return self._sides(queries, k, nprobe, qid_col, qvec_col, query_block_rows, corpus_block_rows)[:2]

    def _sides(self, queries: DataFrame, k: int, nprobe: int | None, qid_col: str, qvec_col: str, query_block_rows: int,
               corpus_block_rows: int) -> tuple[DataFrame, DataFrame, int]:
        spark, lists = queries.sparkSession, len(self.centroids)
        nprobe = min(nprobe or self.nprobe, lists)
        q = queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).alias("qvec"))
        probes = cut_lineage(self._probed(q, nprobe))  # also keeps the parts of the two sides alike
        n_q = probes.count()
        if probes.groupBy("qid").count().where("count > 1").limit(1).count():
            raise ValueError("qid must be unique")
        own = [0] * lists
        for r in self.sizes.collect():  # one row per list
            own[r["list_id"]] = r["n_c"]
        # groups of neighbouring lists with about equal rows, and blocks of a group's rows
        qs = max(1, math.ceil(n_q / query_block_rows))
        wanted = max(1, min(lists, math.ceil(4 * spark.sparkContext.defaultParallelism / qs)))
        fill = max(1, math.ceil(sum(own) / wanted))
        before = np.cumsum(own) - own
        group = (before // fill).astype(int)
        group = np.unique(group, return_inverse=True)[1]
        rows = np.bincount(group, weights=own)
        cs = np.maximum(1, np.ceil(rows / corpus_block_rows)).astype(int)
        first = np.concatenate([[0], np.cumsum(cs * qs)])  # parts of a group: query block, then corpus block
        dealt = F.broadcast(spark.createDataFrame(
            [(c, int(group[c]), int(cs[group[c]]), int(first[group[c]])) for c in range(lists)], "list_id int, g int, cs int, first long"))
        place = F.array(*[F.lit(int(g)) for g in group])
        # the lists of a query group by group
        split = (probes.withColumn("g", F.explode(F.array_distinct(F.transform("lists", lambda c: F.element_at(place, c + 1)))))
                 .withColumn("lists", F.filter("lists", lambda c: F.element_at(place, c + 1) == F.col("g"))))
        groups = F.broadcast(dealt.select("g", "cs", "first").distinct())
        qside = (split.join(groups, "g")
                 .withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(qs)))
                 .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("cs") - 1)))
                 .select((F.col("first") + F.col("qb") * F.col("cs") + F.col("cb")).alias("part"), F.col("qid").alias("id"),
                         F.lit(k).alias("k"), "lists", F.col("qvec").alias("vec")))
        if nprobe < lists:
            dealt = F.broadcast(cut_lineage(dealt.join(probes.select(F.explode("lists").alias("list_id")).distinct(), "list_id")))
        cside = (self.assigned.join(dealt, "list_id")
                 .withColumn("cb", F.pmod(F.xxhash64("id"), F.col("cs")))
                 .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qs - 1))))
                 .select((F.col("first") + F.col("qb") * F.col("cs") + F.col("cb")).alias("part"), "id",
                         F.col("list_id").alias("own"), "vec", "list_id"))
        return qside, cside, int(first[-1])

    def search(self, queries: DataFrame, k: int = 10, nprobe: int | None = None, *, qid_col: str = "qid", qvec_col: str = "qvec",
               query_block_rows: int = 50_000, corpus_block_rows: int = 200_000) -> DataFrame:
        """Top ``k`` among the vectors of each query's ``nprobe`` lists; as many
        as the index was tuned to unless given."""
        qside, cside, parts = self._sides(queries, k, nprobe, qid_col, qvec_col, query_block_rows, corpus_block_rows)
        return topk.rank_candidates(topk.meet(qside, cside, parts, self.dim, k), k)


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact (qid, id) hits that the approximate result also has."""
    a = approx.select("qid", "id").withColumn("_hit", F.lit(1))
    j = exact.select("qid", "id").join(a, ["qid", "id"], "left")
    return j.agg((F.sum(F.coalesce("_hit", F.lit(0))) / F.count(F.lit(1))).alias("recall"))


def default_lists(n_rows: int) -> int:
    """sqrt(N) lists, the usual IVF sizing."""
    return max(1, int(math.sqrt(max(n_rows, 1))))
