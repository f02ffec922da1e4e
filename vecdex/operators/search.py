"""The search API over a query table.

Flow per query row (qid, query, limit):
  F1 validate -> F2 effective limit -> embed (any embedder) -> K2 top-k with
  the per-query limit -> payload join (P7/S14) -> A1 count + A2 response.

Only the valid queries are embedded and scored; rejected ones keep their
error message and a count of 0 in the response table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecdex.functions import text as tx
from vecdex.operators import topk


def validate(queries: DataFrame, query_col: str = "query",
             limit_col: str = "limit") -> DataFrame:
    """F1 + F2: adds ``error`` (null when valid) and ``effective_limit``."""
    return (queries
            .withColumn("error", tx.validation_error(F.col(query_col), F.col(limit_col)))
            .withColumn("effective_limit", tx.effective_limit(F.col(limit_col))))


def attach_payload(hits: DataFrame, index: DataFrame, payload: list[str] | dict,
                   id_col: str = "id", rows_bound: int | None = None,
                   max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Join hits back to the index payload (vector column pruned).

    ``payload`` is a list of column names or a {output: index column} map.
    ``rows_bound`` is a proven upper bound of the hit rows (queries x k, known
    once the query matrix is collected, see ``topk.knn``); under
    ``max_broadcast_rows`` the hits are broadcast and the index is scanned
    once without a shuffle. Without a bound AQE decides from runtime sizes."""
    if isinstance(payload, dict):
        cols = [F.col(src).alias(dst) for dst, src in payload.items()]
    else:
        cols = [F.col(c) for c in payload]
    side = index.select(F.col(id_col).cast("long").alias("id"), *cols)
    if rows_bound is None:
        rows_bound = getattr(hits, "rows_bound", None)
    h = F.broadcast(hits) if rows_bound is not None and rows_bound <= max_broadcast_rows else hits
    return side.join(h, "id", "inner")


def search_hits(queries: DataFrame, index: DataFrame, embedder, dim: int, *,
                payload: list[str] | dict | None = None, id_col: str = "id",
                vec_col: str = "vector", prefilter: Column | None = None,
                query_col: str = "query", limit_col: str = "limit",
                index_normalized: bool = False,
                config: topk.SearchConfig = topk.DEFAULT) -> DataFrame:
    """Hits of the valid queries: qid, rank, id, score[, payload...].

    ``prefilter`` (F5) is applied to the index *before* scoring."""
    v = validate(queries, query_col, limit_col).where(F.col("error").isNull())
    qv = embedder.embed(v.select("qid", query_col, "effective_limit"), query_col, "qvec")
    idx = index.where(prefilter) if prefilter is not None else index
    hits = topk.knn(idx, qv, dim, topk.MAX_K, id_col=id_col, vec_col=vec_col,
                    k_col="effective_limit", index_normalized=index_normalized,
                    config=config)
    if payload:
        hits = attach_payload(hits, idx, payload, id_col=id_col)
    return hits


def responses(queries: DataFrame, hits: DataFrame, hit_cols: list[str],
              query_col: str = "query", limit_col: str = "limit") -> DataFrame:
    """A1 + A2: one row per query: query, requested_limit, count, results
    (array of hit structs in rank order), error. Zero-hit and rejected
    queries keep count 0 and an empty array. Each group holds <= 50 hits."""
    per_q = (hits.groupBy("qid").agg(
        F.count(F.lit(1)).cast("int").alias("count"),
        F.array_sort(F.collect_list(F.struct("rank", *hit_cols))).alias("_r")))
    v = validate(queries, query_col, limit_col)
    return (v.join(per_q, "qid", "left")
            .select("qid", F.col(query_col).alias("query"),
                    F.col("effective_limit").cast("int").alias("requested_limit"),
                    F.coalesce("count", F.lit(0)).alias("count"),
                    F.coalesce(F.transform("_r", lambda r: r.dropFields("rank")),
                               F.array()).alias("results"),
                    "error"))


def suggest(queries: DataFrame, index: DataFrame, embedder, dim: int, *,
            query_col: str = "query", **kw) -> DataFrame:
    """K3: trimmed queries of >= 2 UTF-16 units, top 3 each."""
    q = (queries.where(tx.suggest_eligible(F.col(query_col)))
         .withColumn(query_col, tx.js_trim(F.col(query_col)))
         .withColumn("limit", F.lit(tx.SUGGEST_LIMIT)))
    return search_hits(q, index, embedder, dim, query_col=query_col, limit_col="limit", **kw)


def response_json(resp: DataFrame) -> DataFrame:
    """One JSON document per query (snake_case names)."""
    return resp.select("qid", F.to_json(F.struct(
        "query", "requested_limit", "count", "results")).alias("json"))


def movie_hits(hits: DataFrame) -> DataFrame:
    """Point payload -> result fields (release_year -> year)."""
    return hits.select("qid", "rank", "title", F.col("release_year").alias("year"),
                       "genres", "score", "summary_snippet", "thumbnail_url")


def scroll(index: DataFrame, predicate: Column | None = None, after=None,
           page_size: int = 100, id_col: str = "id") -> DataFrame:
    """One keyset page: rows with id > after matching ``predicate``,
    ordered by id (TakeOrderedAndProject; the page size is the feature)."""
    df = index
    if predicate is not None:
        df = df.where(predicate)
    if after is not None:
        df = df.where(F.col(id_col) > F.lit(after))
    return df.orderBy(id_col).limit(page_size)


def write_scrollable(index: DataFrame, path: str, id_col: str = "id") -> DataFrame:
    """The index range-sorted by id, so that files and row groups hold disjoint
    id ranges and ``scroll`` with ``after`` skips those before it by their
    statistics. Returns the stored table."""
    index.repartitionByRange(id_col).sortWithinPartitions(id_col).write.mode("overwrite").parquet(path)
    return index.sparkSession.read.parquet(path)


def page_numbers(index: DataFrame, page_size: int = 100, id_col: str = "id",
                 predicate: Column | None = None) -> DataFrame:
    """S9 over the whole index: the page each row falls on when scrolling
    with ``page_size``. Uses dense ranks from operators.ids (no global
    single-partition window)."""
    from vecdex.operators.ids import dense_ids
    df = index.where(predicate) if predicate is not None else index
    ranked = dense_ids(df, order_by=id_col, out_col="_pos")
    return ranked.withColumn("page", (F.col("_pos") / page_size).cast("long")).drop("_pos")

