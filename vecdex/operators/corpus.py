"""Corpus build (A3, J1, J2, P1-P3): raw metadata and summary rows ->
typed corpus records.

    metadata rows --A3--> one row per id --+
                                           +--J1 inner--> P1/P2/P3 -> corpus
    summary rows  --A3--> one row per id --+
                                           +--J2 anti both ways -> exclusions
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecdex.functions import text as tx


def last_wins(df: DataFrame, key: str, order_col: str = "ordinal") -> DataFrame:
    """A3: keyed last-write-wins that keeps the first position.

    ``max_by(row, order)`` gives the last values; ``min(order)`` the first
    position. Both are partial aggregates, so a hot key is combined map-side
    before the shuffle."""
    cols = [c for c in df.columns if c not in (key, order_col)]
    return (df.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("_last"),
                 F.min(order_col).alias(order_col))
            .select(key, "_last.*", order_col))


def join_records(meta: DataFrame, summaries: DataFrame, *, strict_json: bool = True,
                 snippet_chars: int = tx.SNIPPET_CHARS) -> DataFrame:
    """J1 + P1 + P2 + P3: inner join on movie_id (one row per id after A3),
    ordinal of the metadata side kept for corpus order."""
    m = last_wins(meta, "movie_id")
    s = last_wins(summaries, "movie_id").drop("ordinal")
    j = m.join(s, "movie_id", "inner")
    return j.select(
        "movie_id", "title",
        tx.release_year(F.col("movie_release_date")).alias("release_year"),
        tx.json_values(F.col("movie_genres"), strict=strict_json).alias("genres"),
        tx.prefix(F.col("summary"), snippet_chars).alias("summary_snippet"),
        "ordinal")


def exclusions(meta: DataFrame, summaries: DataFrame, key: str = "movie_id") -> DataFrame:
    """Ids dropped by the inner join, with the reason.

    One full outer join of the two distinct key sets: each side is shuffled
    once (its distinct), the join reuses that partitioning, and both anti
    sets come out of the same pass."""
    m = meta.select(key).distinct().withColumn("_m", F.lit(True))
    s = summaries.select(key).distinct().withColumn("_s", F.lit(True))
    j = m.join(s, key, "full_outer").where(F.col("_m").isNull() | F.col("_s").isNull())
    return j.select(key, F.when(F.col("_s").isNull(), F.lit("no_summary"))
                    .otherwise(F.lit("no_metadata")).alias("reason"))
