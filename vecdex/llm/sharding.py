"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised, the cells are numbered along a
Hilbert curve, rows are ordered by curve index and the order is cut into runs
of equal row counts. Neighbours on the curve are neighbours in every
dimension, so a run covers a small box of each dimension and readers can skip
it by its minima and maxima.

All steps are DataFrame functions. Cells are equal-depth and the same on every
run: cut points are exact quantiles, from the counts of a dimension's distinct
values (whole strings, not prefixes) in a distributed sort, and only those few
values per dimension reach the driver. Ranks come from a distributed sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecdex.llm.common import fresh
from vecdex.operators.ids import dense_ids
from vecdex.session import Scratch

BITS = 5


def dimension(docs: DataFrame, name: str) -> Column:
    """A column as something to order by: strings as they are (by their bytes),
    numbers and times as numbers; a number that is not one counts as null."""
    kind = dict(docs.dtypes)[name]
    if kind == "string":
        return F.col(name)
    number = F.unix_micros(F.col(name).cast("timestamp")).cast("double") if kind in (
        "date", "timestamp", "timestamp_ntz") else F.col(name).cast("double")
    return F.when(~F.isnan(number), number)


def cell(value: Column, cuts: list, bits: int = BITS) -> Column:
    """How many cut points lie below the value, stretched over the axis so that
    a dimension of few values weighs as much as one of many; null is below all."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: F.coalesce(c < value, F.lit(False))))
    return F.floor(below * (1 << bits) / (len(cuts) + 1)).cast("int")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve over ``len(cells)`` dimensions of
    ``bits`` bits, by the transposed form: from the highest bit down the lower
    bits of an axis are either inverted or exchanged with the first axis, then
    the axes are Gray-coded and their bits interleaved."""
    n = len(cells)
    names = [f"x{i}" for i in range(n)]

    def step(state: Column, q: Column) -> Column:
        x, low = [state[name] for name in names], q - 1
        for i in range(n):
            on = x[i].bitwiseAND(q) != 0
            swap = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
            head = x[0].bitwiseXOR(F.when(on, low).otherwise(swap))
            if i:
                x[i] = F.when(on, x[i]).otherwise(x[i].bitwiseXOR(swap))
                x[0] = head
            else:
                x[0] = F.when(on, head).otherwise(x[0])
        return F.struct(*[v.alias(name) for v, name in zip(x, names, strict=True)])

    def gray(state: Column) -> Column:
        x = [state[names[0]]]
        for name in names[1:]:
            x.append(state[name].bitwiseXOR(x[-1]))
        flip = reduce(lambda a, b: a.bitwiseXOR(b), [
            F.when(x[-1].bitwiseAND(F.lit(1 << k)) != 0, F.lit((1 << k) - 1)).otherwise(F.lit(0)) for k in range(1, bits)],
            F.lit(0))
        x = [v.bitwiseXOR(flip) for v in x]
        return reduce(lambda a, b: a + b, [
            F.shiftleft(F.shiftright(x[i], k).bitwiseAND(F.lit(1)).cast("long"), k * n + n - 1 - i)
            for k in range(bits) for i in range(n)])

    start = F.struct(*[F.least(c, F.lit((1 << bits) - 1)).cast("int").alias(name) for c, name in zip(cells, names, strict=True)])
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(bits - 1, 0, -1)]), start, step, gray)


def cut_points(docs: DataFrame, dims: list[str], bits: int = BITS) -> dict[str, list]:
    """At most 2^bits - 1 distinct quantiles per dimension, exact and over all
    rows: of the distinct values in order, those at which the running count of
    rows passes another 2^bits-th of all."""
    work = Scratch(docs.sparkSession, "cuts")
    out = {}
    for d in dict.fromkeys(dims):
        counts = docs.select(dimension(docs, d).alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        # ranges of values, so that no task holds all of them; one row per range is summed up
        ranged = work.write(counts.repartitionByRange("v").select("v", "n", F.spark_partition_id().alias("p")))
        sums = ranged.groupBy("p").agg(F.sum("n").alias("all"))
        before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        sums = work.write(sums.select("p", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"), F.sum("all").over(Window.partitionBy()).alias("total")))
        upto = F.sum("n").over(Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
        share = lambda c: F.floor(c * (1 << bits) / F.col("total"))
        passed = ranged.join(F.broadcast(sums), "p").select("v", "n", "total", upto.alias("upto")).where(
            (share(F.col("upto")) > share(F.col("upto") - F.col("n"))) & (F.col("upto") < F.col("total")))
        out[d] = sorted(r["v"] for r in passed.collect())
    work.close()
    return out


def curve(docs: DataFrame, dims: list[str], bits: int = BITS) -> Column:
    """The curve index of each row of ``docs`` as an expression."""
    cuts = cut_points(docs, dims, bits)
    return hilbert_index([cell(dimension(docs, d), cuts[d], bits) for d in dims], bits)


def hilbert_shards(docs: DataFrame, dims: list[str], id_col: str = "doc_id", text_col: str = "text",
                   shards: int = 8, bits: int = BITS) -> DataFrame:
    """``id_col, size, text_crc32, hilbert, shard, slot`` for every row.

    Shards are runs of the curve and their row counts differ by at most one;
    ``slot`` counts from 0 in each. Nulls sort first in their dimension; null
    text has size 1 and the checksum of no bytes. Rows that tie on the curve
    follow their id, then a hash of the returned values. Repeated rows each get
    a place of their own; an empty table gives an empty result. Columns not
    named are not read.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       curve(docs, dims, bits).alias("hilbert"))
    ranked = dense_ids(rows, ["hilbert", id_col], "__rank")
    total = ranked.count()
    return (ranked.withColumn("shard", F.expr(f"int(__rank * {shards} div {max(total, 1)})"))
            .withColumn("slot", F.expr(f"__rank - (shard * {total}L + {shards - 1}) div {shards}")).drop("__rank"))


def write_shards(docs: DataFrame, path: str, dims: list[str], id_col: str = "doc_id", files: int = 8,
                 bits: int = BITS) -> None:
    """Write ``docs`` as parquet files that are runs of the curve, each sorted by
    it, so that file and row-group statistics prune in every dimension."""
    key = fresh(docs, "hilbert")
    (docs.withColumn(key, curve(docs, dims, bits)).repartitionByRange(files, key, F.col(id_col))
     .sortWithinPartitions(key, id_col).drop(key).write.parquet(path))
