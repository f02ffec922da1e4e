"""Keyed event-time operators over event tables: ST3 debounce and ST4 rate
control, each as a batch job and as a Structured Streaming job.

Batch forms split hot keys by time
-----------------------------------
A per-key window over all of a key's rows puts a key that holds a third of
the table into one task. Both operators only look a bounded time span
around each row (the debounce gap, the rate window), so rows are grouped by
(key, time bucket) instead, with bucket length >= that span. Rows near a
bucket edge are copied into the neighbouring bucket as *context* rows; a
window runs per (key, bucket) and only the bucket's own rows are kept. The
copies are bounded by the rows within one span of an edge.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from vecdex.functions.text import suggest_eligible

_US = 1_000_000
# length of a time bucket in spans: one row in about so many is copied as context
BUCKET_SPANS = 16


def event_micros(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of ``ts`` independent of the session time zone:
    a TIMESTAMP_NTZ is read as UTC wall time (as the SQL engines do), a
    TIMESTAMP is an instant already."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(ts))
    return F.unix_micros(F.col(ts).cast("timestamp"))


def event_time(df: DataFrame, ts: str) -> Column:
    """``ts`` as a TIMESTAMP instant (what watermarks need), NTZ read as UTC."""
    return F.timestamp_micros(event_micros(df, ts))


def _with_context(df: DataFrame, us: Column, span_us: int, bucket_us: int,
                  direction: int) -> DataFrame:
    """Rows tagged with (bucket, owner); rows within ``span_us`` of the edge
    facing ``direction`` (-1: previous bucket, +1: next bucket) are copied
    into that bucket with owner = false."""
    b = F.floor(us / F.lit(bucket_us)).cast("long")
    base = df.withColumn("_us", us).withColumn("_b", b)
    if direction < 0:
        near = F.col("_us") - F.col("_b") * bucket_us < span_us
    else:
        near = (F.col("_b") + 1) * bucket_us - F.col("_us") <= span_us
    copies = F.when(near, F.array(F.struct(F.col("_b").alias("b"), F.lit(True).alias("o")),
                                  F.struct((F.col("_b") + direction).alias("b"),
                                           F.lit(False).alias("o"))))
    tags = F.coalesce(copies, F.array(F.struct(F.col("_b").alias("b"), F.lit(True).alias("o"))))
    return (base.withColumn("_t", F.explode(tags))
            .withColumn("_b", F.col("_t.b")).withColumn("_own", F.col("_t.o")).drop("_t"))


def _bucket(span_us: int, seconds: float | None) -> int:
    return max(span_us, 1, BUCKET_SPANS * span_us if seconds is None else int(seconds * _US))


def debounce(events: DataFrame, key: str, ts: str, gap_seconds: float, *,
             tie: str | None = None, bucket_seconds: float | None = None,
             query_col: str | None = None) -> DataFrame:
    """ST3 batch: keep a row when the next row of the same key (ordered by
    ts, then ``tie``) is absent or at least ``gap_seconds`` later. With
    ``query_col`` the kept rows must also be eligible for suggestions (two
    UTF-16 units or more once trimmed). Buckets last ``BUCKET_SPANS`` gaps
    unless ``bucket_seconds`` says otherwise."""
    gap_us = int(round(gap_seconds * _US))
    bucket_us = _bucket(gap_us, bucket_seconds)
    tagged = _with_context(events, event_micros(events, ts), gap_us, bucket_us, -1)
    order = [F.col("_us")] + ([F.col(tie)] if tie else [])
    w = Window.partitionBy(key, "_b").orderBy(*order)
    nxt = F.lead("_us").over(w)
    out = (tagged.withColumn("_next", nxt)
           .where(F.col("_own") & (F.col("_next").isNull() | (F.col("_next") >= F.col("_us") + gap_us))))
    if query_col:
        out = out.where(suggest_eligible(F.col(query_col)))
    return out.drop("_us", "_b", "_own", "_next")


def rate_audit(events: DataFrame, key: str, ts: str, window_seconds: float, max_events: int,
               *, bucket_seconds: float | None = None) -> DataFrame:
    """ST4 audit: rows of the same key in the trailing window [ts - w, ts]
    (both ends inclusive, equal timestamps included) and whether that count
    exceeds ``max_events``."""
    w_us = int(round(window_seconds * _US))
    bucket_us = _bucket(w_us, bucket_seconds)
    tagged = _with_context(events, event_micros(events, ts), w_us, bucket_us, +1)
    win = Window.partitionBy(key, "_b").orderBy("_us").rangeBetween(-w_us, 0)
    out = (tagged.withColumn("n_window", F.count(F.lit(1)).over(win))
           .where(F.col("_own"))
           .withColumn("over_limit", F.col("n_window") > max_events))
    return out.drop("_us", "_b", "_own")


# ---------------------------------------------------------------------------
# ST4 limiter replay (sequential per key -> state)
# ---------------------------------------------------------------------------

def admissions(arrivals: np.ndarray, recent: list[int], most: int, window: int) -> tuple[np.ndarray, list[int]]:
    """Start times (integer microseconds) of one key's calls, given in order of
    arrival. A call starts at the latest of three times: its arrival, the start
    of the call before it, and ``window`` after the start of the call ``most``
    places before it. ``recent`` holds the last ``most`` starts so far; the new
    ones are returned with them."""
    starts = list(recent)
    for t in arrivals.tolist():
        earliest = [t, *starts[-1:]]
        if len(starts) >= most:
            earliest.append(starts[-most] + window)
        starts.append(max(earliest))
    return np.array(starts[len(recent):], np.int64), starts[-most:]


REPLAY_SCHEMA = "event_id long, user_id long, arrival double, admitted double, delay double"


def limiter_replay_stream(events: DataFrame, key: str, ts: str, id_col: str,
                          max_per_window: int, window_seconds: float = 1.0,
                          watermark: str = "10 minutes") -> DataFrame:
    """ST4 as a stateful stream: when each call may start if at most
    ``max_per_window`` start in any window. State is the last
    ``max_per_window`` start times of a key and expires by event time once they
    are a window old. Events later than the watermark are dropped by Spark. One
    row per event: its arrival, start and delay in seconds."""
    us, window = 1_000_000, round(window_seconds * 1_000_000)
    src = (events.withColumn("_ts", event_time(events, ts)).withWatermark("_ts", watermark)
           .select(F.col(id_col).alias("event_id"), F.col(key).alias("user_id"), "_ts",
                   F.unix_micros("_ts").alias("us")))

    def step(k, chunks, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(["us", "event_id"])
        if rows.empty:
            return
        arrived = rows["us"].to_numpy(np.int64)
        starts, recent = admissions(arrived, list(state.get[0]) if state.exists else [], max_per_window, window)
        state.update((recent,))
        state.setTimeoutTimestamp((recent[-1] + window) // 1000 + 1)
        yield pd.DataFrame({"event_id": rows["event_id"].to_numpy(), "user_id": k[0], "arrival": arrived / us,
                            "admitted": starts / us, "delay": (starts - arrived) / us})

    return src.groupBy("user_id").applyInPandasWithState(
        step, REPLAY_SCHEMA, "starts array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def debounce_stream(events: DataFrame, key: str, ts: str, gap: str, *,
                    tie: str = "event_id", watermark: str = "10 minutes") -> DataFrame:
    """ST3 stream: session windows of ``gap`` per key; the last event of a
    session is the one a debouncer emits (ties broken by ``tie``). A session is
    emitted once the watermark has passed it, so the last sessions of a stream
    that ends stay in its state (``run_debounce_stream`` can flush them); events
    later than the watermark are dropped."""
    e = events.withColumn("_ts", event_time(events, ts)).withWatermark("_ts", watermark)
    cols = [c for c in events.columns if c != key]
    return (e.groupBy(F.col(key), F.session_window("_ts", gap))
            .agg(F.max_by(F.struct(*cols), F.struct("_ts", tie)).alias("_last"))
            .select(key, "_last.*"))


def run_debounce_stream(debounced: DataFrame, *, sink: str, checkpoint: str, flush: bool = False) -> DataFrame:
    """Run a ``debounce_stream`` over the input there is and read its result.
    With ``flush`` the input ends there: sessions the watermark has not closed
    are given too, so the result is that of the batch form. The state keeps
    every session for that and a micro-batch writes them all anew."""
    if flush:
        def whole(sessions: DataFrame, batch_id: int) -> None:
            sessions.write.mode("overwrite").parquet(sink)
        w = debounced.writeStream.outputMode("complete").foreachBatch(whole)
    else:
        w = debounced.writeStream.outputMode("append").format("parquet").option("path", sink)
    w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return debounced.sparkSession.read.parquet(sink)
