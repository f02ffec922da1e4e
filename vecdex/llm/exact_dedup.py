"""Exact dedup as a stateful stream.

Documents arrive as (digest, id, locator): the SHA-256 of the normalised text,
the stable identifier, and where the text lies (file and row). A streaming
aggregation keeps one entry per digest in a disk-backed state store, without
expiry: the entry that stays and how many arrived. Copies are combined before
the shuffle, so a group that holds a third of all rows is one state update
per task. A digest that was seen before is a hit only; the texts behind hits
are read through their locators and compared in full, and a digest under
which different texts meet is split by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecdex.llm.common import ascii_lower, fresh
from vecdex.session import Scratch, scratch_path

#: rows of about 150 bytes that may be broadcast
BROADCAST_ROWS = 200_000
#: state on local disk, copied to the shared folder with every batch; files are not
#: allocated ahead, which costs 4 MB a state partition whatever it holds, and an executor
#: releases a partition's memory and files once its task has committed
_STATE = {"spark.sql.streaming.stateStore.providerClass":
          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
          "spark.sql.streaming.stateStore.unloadOnCommit": "true"}


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty; texts are equal when this is identical."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def located(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that says where each row lies in its files. Rows
    that come from no file are written to the shared folder first."""
    name = fresh(docs, "locator")
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(name)
    try:
        return docs.select("*", at), name
    except AnalysisException:
        path = scratch_path(docs.sparkSession, "dedup-input")
        docs.write.parquet(path)
        return docs.sparkSession.read.parquet(path).select("*", at), name


def track(arrivals: DataFrame, checkpoint: str, out: str) -> None:
    """Run the stateful stream over what is available of ``arrivals`` (``digest``,
    ``id``, ``locator``) and write the entries that each micro-batch changed.

    Called again with the same ``checkpoint`` and ``out`` it goes on from its
    state: an identifier seen in any earlier run still counts."""
    spark = arrivals.sparkSession
    entries = arrivals.groupBy("digest").agg(F.max(F.struct("id", "locator")).alias("keep"),
                                             F.count(F.lit(1)).alias("group_size"))
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        stream = (entries.writeStream.outputMode("update").trigger(availableNow=True)
                  .option("checkpointLocation", checkpoint)
                  .foreachBatch(lambda changed, k: changed.write.mode("overwrite").parquet(f"{out}/batch={k}"))
                  .start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    stream.awaitTermination()


def entries(spark: SparkSession, out: str) -> DataFrame:
    """The latest entry of each digest: ``digest, keep, group_size``. Both only
    grow from batch to batch, so the latest is the largest."""
    return (spark.read.parquet(out).groupBy("digest")
            .agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size")))


def decisions(docs: DataFrame, locator: str, id_col: str = "doc_id", text_col: str = "text",
              digest: Callable[[Column], Column] = sha256, files_per_batch: int = 100_000) -> DataFrame:
    """``locator, id, digest, keep_id, group_size, kept`` for every row of
    ``docs``, whose rows are named by the column ``locator``. The texts are read
    once for the digests, and those behind hits once more."""
    spark = docs.sparkSession
    work = Scratch(spark, "dedup")
    base = work.path
    docs.select(digest(normalised(F.col(text_col))).alias("digest"), F.col(id_col).alias("id"),
                F.col(locator).alias("locator")).write.parquet(f"{base}/arrivals")
    arrivals = spark.read.parquet(f"{base}/arrivals")
    if arrivals.isEmpty():
        found = arrivals.groupBy("digest").agg(F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    else:
        stream = (spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", files_per_batch)
                  .parquet(f"{base}/arrivals"))
        track(stream, f"{base}/checkpoint", f"{base}/entries")
        # materialised, so that the joins below shuffle both sides and Spark can split
        # a digest that holds a third of all rows
        found = work.write(entries(spark, f"{base}/entries"))

    hits = arrivals.join(found.where("group_size > 1").select("digest", F.col("keep.locator").alias("kept_at")), "digest")
    texts = _texts(work, docs, locator, text_col, hits.select("locator", "digest", "kept_at"))
    kept_texts = texts.where(F.col("locator") == F.col("kept_at")).select("digest", F.col("text").alias("kept_text"))
    # the clashes, none as a rule, are written before they are made distinct: that
    # step shares no shuffle with the join, which can then split a frequent digest
    clashes = work.write(texts.join(kept_texts, "digest").where(F.col("text") != F.col("kept_text")).select("digest"))
    clashing = work.write(clashes.distinct())
    if clashing.isEmpty():
        joined = arrivals.join(found, "digest")
    else:  # different texts under one digest: group those by the full text
        full = _texts(work, docs, locator, text_col, arrivals.join(clashing, "digest"))
        split = full.groupBy("digest", "text").agg(
            F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        joined = (arrivals.join(found.join(clashing, "digest", "left_anti"), "digest")
                  .unionByName(full.join(split, ["digest", "text"]).drop("text")))
    return joined.select("locator", "id", "digest", F.col("keep.id").alias("keep_id"), "group_size",
                         (F.col("locator") == F.col("keep.locator")).alias("kept"))


def _texts(work: Scratch, docs: DataFrame, locator: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (rows with a ``locator``) with the normalised text found there."""
    rows = docs.select(F.col(locator).alias("at__"), F.col(text_col).alias("text__"))
    return (rows.join(_small(work, wanted), F.col("at__") == F.col("locator"))
            .withColumn("text", normalised(F.col("text__"))).drop("at__", "text__"))


def _small(work: Scratch, rows: DataFrame) -> DataFrame:
    """``rows`` to be broadcast if they are few enough, else to be shuffled."""
    rows = work.write(rows)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_digest``.

    Of texts that are equal after lower-casing A-Z the row with the largest id
    stays; among rows that share that id, the last one by file and row. Null
    text counts as empty, a null id is smaller than any other. Input columns
    named like the new ones are replaced. An empty table gives an empty result.
    """
    new = ("keep_id", "group_size", "kept", "text_digest")
    docs, locator = located(docs.drop(*[c for c in docs.columns if c.lower() in new]))
    own = decisions(docs, locator, id_col, text_col, **options).select(
        F.col("locator").alias("at__"), "keep_id", "group_size", "kept", F.col("digest").alias("text_digest"))
    return (docs.join(own, F.col(locator) == F.col("at__"))
            .select(*[F.col(c) for c in docs.columns if c != locator], *new))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``. Only the
    places of the rows that go are joined with the documents."""
    rows, locator = located(docs)
    gone = decisions(rows, locator, id_col, text_col, **options).where("not kept").select("locator")
    return rows.join(_small(Scratch(docs.sparkSession, "gone"), gone), F.col(locator) == F.col("locator"), "left_anti").select(*[F.col(c) for c in docs.columns])


def kept_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_digest`` for every row, without
    the documents' other columns."""
    rows, locator = located(docs)
    return decisions(rows, locator, id_col, text_col, **options).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_digest"))


#: DuckDB SQL for op6's columns
SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
