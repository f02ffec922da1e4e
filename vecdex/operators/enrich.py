"""Poster enrichment (J5, F8, S10, F3) as one pass of joins.

The reference looks each point up one by one in a remote catalogue and keeps
the rank-1 result. Here the catalogue is a table (title, year, rank,
poster_path) and the lookup is a join:

* a point with a year matches catalogue rows of the same title and year;
* a point without a year matches every row of its title;
* only the best-ranked match counts, even when its poster is null (no
  fallback to rank 2); an empty poster path is not written (F8).

The catalogue is first reduced to one best row per (title, year) and per
title, so each join is N:1: no point ever pairs with more than one
catalogue row, however many rows share a hot title. Points that share a hot
title meet a one-row key on the other side, which AQE's skew handling (or a
size-checked broadcast) splits without duplicating work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecdex.operators.index import needs_enrichment



def best_matches(catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(title, year) -> best row, and title -> best row (min rank).

    One aggregate per (title, year) (partial + final, so a hot title is
    combined map-side); the per-title answer is a second, much smaller
    aggregate over those groups, sharing the first exchange."""
    per_ty = (catalogue.groupBy("title", "year")
              .agg(F.min_by(F.col("poster_path"), F.col("rank")).alias("poster_path"),
                   F.min("rank").alias("match_rank")))
    by_title_year = per_ty.where(F.col("year").isNotNull())
    by_title = (per_ty.groupBy("title")
                .agg(F.min_by(F.col("poster_path"), F.col("match_rank")).alias("poster_path"),
                     F.min("match_rank").alias("match_rank")))
    return by_title_year, by_title


def lookup(points: DataFrame, catalogue: DataFrame, *, title_col: str = "title",
           year_col: str = "release_year", key: str = "id",
           broadcast_rows: int | None = None) -> DataFrame:
    """J5 + F8: (key, poster_path) for every point; null when there is no
    match, the rank-1 path is null, or it is empty."""
    by_ty, by_t = best_matches(catalogue)
    if broadcast_rows is not None:
        if by_ty.count() <= broadcast_rows:
            by_ty = F.broadcast(by_ty)
        if by_t.count() <= broadcast_rows:
            by_t = F.broadcast(by_t)
    p = points.select(key, F.col(title_col).alias("title"), F.col(year_col).alias("year"))
    with_year = (p.where(F.col("year").isNotNull())
                 .join(by_ty, ["title", "year"], "left")
                 .select(key, "poster_path"))
    no_year = (p.where(F.col("year").isNull())
               .join(by_t, ["title"], "left")
               .select(key, "poster_path"))
    return with_year.unionByName(no_year).withColumn(
        "poster_path", F.nullif(F.col("poster_path"), F.lit("")))


def enrich(points: DataFrame, catalogue: DataFrame, *, col: str = "thumbnail_url",
           key: str = "id", broadcast_rows: int | None = None, **kw) -> DataFrame:
    """F3 -> J5 -> F8 -> S10 over a points frame: only rows whose ``col`` is
    null are looked up; a found path fills ``col``; everything else is
    untouched. Idempotent: a second pass changes nothing."""
    todo = needs_enrichment(points, col)
    found = (lookup(todo, catalogue, key=key, broadcast_rows=broadcast_rows, **kw)
             .where(F.col("poster_path").isNotNull())
             .select(key, F.col("poster_path").alias("_new")))
    if broadcast_rows is not None and found.count() <= broadcast_rows:
        found = F.broadcast(found)
    out = points.join(found, key, "left")
    return out.select(*[F.coalesce(F.col(col), F.col("_new")).alias(col) if c == col
                        else F.col(c) for c in points.columns])
