"""ST1 streaming search and ST2 incremental index load.

Both run the batch operators inside ``foreachBatch``: per-query top-k needs
a window over each query's candidates, which Structured Streaming does not
allow on a stream directly, while each micro-batch is an ordinary bounded
DataFrame. Each micro-batch writes to ``<sink>/batch_id=<n>`` with overwrite,
so a re-run batch (after a failure) replaces its own output: with the
checkpoint this gives exactly-once results per batch id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from vecdex.operators import search
from vecdex.operators.index import VectorIndex, one_per_key
from vecdex.session import scratch_path


def file_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    """Parquet files as a stream source with the batch schema, ``max_files`` in
    a micro-batch; with None all there are, so that no event is late behind
    those of another file. A single file is watched through a glob on its folder
    (the file source lists folders)."""
    batch = spark.read.parquet(path)
    schema = batch.schema
    src = path
    files = batch.inputFiles()
    if len(files) == 1 and files[0].rstrip("/").endswith("/" + os.path.basename(path.rstrip("/"))):
        head, name = os.path.split(path.rstrip("/"))
        src = head + "/" + name[:-1] + "[" + name[-1] + "]"
    reader = spark.readStream.schema(schema)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(src)


def run_search_stream(queries: DataFrame, index: DataFrame, embedder, dim: int, *,
                      sink: str, checkpoint: str, payload=None,
                      available_now: bool = True, **kw):
    """ST1: query stream -> F1/F2 -> embed -> K2 -> hits, per micro-batch.

    ``index`` should be a stored table (e.g. ``VectorIndex.read()``): each
    micro-batch scans it, so a lazily embedded corpus would be re-embedded
    per batch. Returns the started (or, with ``available_now``, finished)
    query."""
    def per_batch(bdf: DataFrame, batch_id: int) -> None:
        hits = search.search_hits(bdf, index, embedder, dim, payload=payload, **kw)
        hits.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    w = queries.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def search_stream_results(spark: SparkSession, queries: DataFrame, index: DataFrame,
                          embedder, dim: int, **kw) -> DataFrame:
    """Run ST1 to completion over the available input and read its hits."""
    sink = scratch_path(spark, "st1-sink")
    run_search_stream(queries, index, embedder, dim, sink=sink,
                      checkpoint=scratch_path(spark, "st1-ckpt"), **kw)
    return spark.read.parquet(sink).drop("batch_id")


def run_ingest_stream(rows: DataFrame, idx: VectorIndex, embedder, text_col: str, *,
                      checkpoint: str, dim: int, available_now: bool = True,
                      prepare=None, seq_col: str | None = None):
    """ST2: new corpus rows -> embed -> key upsert into the index (a ``BucketIndex``
    rewrites only the buckets that a micro-batch touches).

    ``prepare`` maps a micro-batch to index rows (id + payload + text) before
    embedding; of several rows for an id in a batch the highest ``seq_col``
    wins (different rows without one raise). The first batch creates the index
    when none exists."""
    def per_batch(bdf: DataFrame, batch_id: int) -> None:
        b = prepare(bdf) if prepare else bdf
        b = one_per_key(b, "id", seq_col)
        pts = embedder.embed(b, text_col, "vector").drop(text_col)
        if not idx.versions():
            type(idx).create(pts, idx.path, dim)
        else:
            idx.upsert(pts)

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q

