"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share a token budget by weight; no target exceeds ``max_epochs`` times
its source's size, and what a capped source cannot take is reshared among the
others. A source is taken whole as often as its target holds its size; the
rest of the target is a weighted sample without replacement: every document
draws the exponential key ``-ln(u) / quality`` from a hash of its id, the
documents of a source are ordered by that key, and the sorted run is taken
while the running size stays near the budget.

The running size is not one window per source, since a source may hold a third
of all rows: keys are cut into ``buckets`` ranges per doubling of the key, sizes
are summed per (source, range) with map-side aggregation, and a window runs
inside each range only. The key of weight w is exponential with rate w, and on
the logarithmic scale a weight only shifts it: whatever the weights are, and
however they differ, a range expects less than 0.26 / ``buckets`` of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecdex.llm.common import fresh, n_words
from vecdex.session import cut_lineage

WEIGHTS = (5, 2, 1)
#: ranges per doubling of the key
BUCKETS = 1024
#: hexadecimal digits of the md5 that make the uniform number, and their range
_DIGITS, _RANGE = 13, float(1 << 52)


def quality_weight(text: Column) -> Column:
    """Between 1/21 and 1: falls with the share of markup and table signs."""
    text = F.coalesce(text, F.lit(""))
    signs = F.regexp_count(text, F.lit("[#*$%&|<>]"))
    return 1.0 / (1.0 + 20.0 * signs / (F.length(text) + 1.0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
                   max_epochs: float = 2.0) -> DataFrame:
    """``source, source_size`` (one row per source) with ``target`` added.

    Sources take ``weights`` in turn, in code point order, null last. The
    windows here see one row per source, never documents. With ``w`` summed
    over the sources not yet capped, a source is capped where its limit per
    weight lies below the level that the others would get.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    before = Window.orderBy("__fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("__w", F.get(table, place % len(weights)))
            .withColumn("__cap", max_epochs * F.col("source_size"))
            .withColumn("__fill", F.col("__cap") / F.col("__w"))
            .withColumn("__level", (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                        / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
            .withColumn("__best", F.max(F.when(F.col("__fill") >= F.col("__level"), F.col("__level"))).over(everything))
            .withColumn("target", F.coalesce(F.least("__cap", F.col("__best") * F.col("__w")), F.col("__cap")))
            .drop("__w", "__cap", "__fill", "__level", "__best"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        quality: Column | None = None, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
        max_epochs: float = 2.0, seed: str = "mix", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target``, ``copies``
    (times the mix takes the document) and ``taken`` (words it takes).

    The same rows give the same result on every run. Null text has size 0 and
    takes nothing; a null source is a source of its own; rows without an id draw
    their number from their text. ``quality`` is any positive column, such as a
    score that was joined to ``docs``; without it a count of markup signs stands
    in. Rows that tie in key and id are ordered by their content, and
    equal rows are interchangeable. Input columns named like the new ones are
    replaced. An empty table gives an empty result.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("size", "source_size", "target", "copies", "taken")])
    source, key, bucket, run = (fresh(docs, s) for s in ("source", "key", "bucket", "run"))
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("#"), F.md5(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"))))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, _DIGITS)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / _RANGE
    weight = quality_weight(F.col(text_col)) if quality is None else quality
    rows = (docs.withColumn("size", n_words(F.col(text_col)))
            .withColumn(key, -F.log(uniform) / weight)
            .withColumn(source, F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")))
            .withColumn(bucket, F.floor(F.log2(F.col(key)) * buckets).cast("int")))
    sums = cut_lineage(rows.groupBy(source, bucket).agg(F.sum("size").alias("__n"), F.max(source_col).alias("source")))
    sizes = sums.groupBy(source, "source").agg(F.sum("__n").alias("source_size"))
    runs = (sums.withColumn("__before", F.coalesce(F.sum("__n").over(  # one row per range of a source
                Window.partitionBy(source).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .join(source_targets(sizes, weights, share, max_epochs).drop("source"), source)
            .select(F.col(source).alias("__s"), F.col(bucket).alias("__b"), "__before", "source_size", "target"))
    flat = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    order = Window.partitionBy(source, bucket).orderBy(key, F.col(id_col), *[F.xxhash64(c) for c in flat if c != id_col])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    fits = (F.col("__before") + F.col(run) - F.col("size") / 2 <= rest) & (rest > 0)
    return (rows.withColumn(run, F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .join(runs, (F.col(source) == F.col("__s")) & (F.col(bucket) == F.col("__b")))
            .withColumn("copies", (epochs + F.when(fits, 1).otherwise(0)).cast("int"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop(source, key, bucket, run, "__s", "__b", "__before"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every document as often as the mix takes it."""
    copy = fresh(docs, "copy")
    mixed = mix(docs, **options)
    return mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*[F.col(c) for c in docs.columns])


#: DuckDB SQL for op10's columns
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / (1.0 / (1.0 + 20.0 * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', ''))) / (length(coalesce(text, '')) + 1.0))) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS fill FROM s),
v AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) AS lv
  FROM c WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT *, coalesce(least(cap, max(CASE WHEN fill >= lv THEN lv END) OVER () * w), cap) AS target FROM v),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN target - epochs * source_size > 0 AND run - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
