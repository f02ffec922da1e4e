"""Dense 0-based ids in a given order, at scale.

``row_number() over (order by k)`` without a partition clause moves every
row into one task. Instead:

1. range-partition and sort by the order key plus a row hash (distributed
   sort; a hot key value is split over several partitions);
2. tag rows with ``monotonically_increasing_id`` = (partition << 33) + offset;
3. checkpoint to the shared folder so both passes see the same rows even
   if an executor is lost and a stage re-runs;
4. count rows per partition (partial aggregate; one row per partition),
   prefix-sum those counts (a table bounded by the number of partitions,
   so broadcasting it is safe) and add the partition start to the offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecdex.session import cut_lineage

_LOW_BITS = (1 << 33) - 1


def dense_ids(df: DataFrame, order_by: str | list[str], out_col: str = "id",
              num_partitions: int | None = None) -> DataFrame:
    keys = [F.col(k) for k in ([order_by] if isinstance(order_by, str) else order_by)]
    # a row hash breaks ties, so rows sharing one hot key value still spread
    # over several range partitions (and equal keys get a stable order)
    keys.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_mono", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged)
    part = F.shiftright(F.col("_mono"), 33)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the global window below sees only those rows
    starts = counts.withColumn(
        "_start", F.sum("_n").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1))).fillna(0, subset=["_start"])
    return (tagged.join(F.broadcast(starts.select("_part", "_start")),
                        part == F.col("_part"))
            .withColumn(out_col, F.col("_start") + F.col("_mono").bitwiseAND(F.lit(_LOW_BITS)))
            .drop("_mono", "_part", "_start"))
