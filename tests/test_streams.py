"""Streaming and event operators (ST1-ST4): batch forms against brute force
(with small buckets so the context copies are exercised), stream forms
against the batch forms."""

import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vecdex.operators import embed, search
from vecdex.streaming import events as ev
from vecdex.streaming import search as st
from vecdex.session import scratch_path
from conftest import SF_ORACLE


def _events(spark, n=400, users=3, seed=3):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2024, 1, 1)
    ts = np.sort(rng.integers(0, 3_600_000, size=n))          # ms within an hour
    rows = [(i, t0 + dt.timedelta(milliseconds=int(t)), int(rng.integers(0, users)))
            for i, t in enumerate(ts)]
    rows.append((n, rows[-1][1], rows[-1][2]))                # equal timestamps
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id"])


def brute_debounce(pdf, gap_ms):
    keep = set()
    for _, g in pdf.sort_values(["ts", "event_id"]).groupby("user_id"):
        ts, ids = list(g["ts"]), list(g["event_id"])
        for i in range(len(ts)):
            if i + 1 == len(ts) or ts[i + 1] - ts[i] >= pd.Timedelta(milliseconds=gap_ms):
                keep.add(ids[i])
    return keep


def brute_rate(pdf, w_ms):
    out = {}
    for _, g in pdf.groupby("user_id"):
        for _, r in g.iterrows():
            lo = r["ts"] - pd.Timedelta(milliseconds=w_ms)
            out[r["event_id"]] = int(((g["ts"] >= lo) & (g["ts"] <= r["ts"])).sum())
    return out


@pytest.mark.parametrize("gap_ms,bucket_s", [(300, 60.0), (20_000, 30.0), (20_000, 3600.0)])
def test_debounce_batch(spark, gap_ms, bucket_s):
    pdf = _events(spark)
    df = spark.createDataFrame(pdf)
    got = {r["event_id"] for r in ev.debounce(df, "user_id", "ts", gap_ms / 1000, tie="event_id",
                                              bucket_seconds=bucket_s).collect()}
    assert got == brute_debounce(pdf, gap_ms)


@pytest.mark.parametrize("w_ms,bucket_s", [(1000, 60.0), (30_000, 30.0)])
def test_rate_audit(spark, w_ms, bucket_s):
    pdf = _events(spark)
    df = spark.createDataFrame(pdf)
    got = {r["event_id"]: r["n_window"] for r in
           ev.rate_audit(df, "user_id", "ts", w_ms / 1000, 2, bucket_seconds=bucket_s).collect()}
    assert got == brute_rate(pdf, w_ms)


def start_times(arrivals, most, window):
    """Brute force: the first microsecond-sized time, at or after the arrival and
    the start before, at which fewer than ``most`` starts lie in the window."""
    out = []
    for t in arrivals:
        t = max([t, *out[-1:]])
        for candidate in sorted({t, *(s + window for s in out if s + window > t)}):
            if sum(candidate - window < s for s in out) < most:
                out.append(candidate)
                break
    return out


def test_admissions_by_brute_force():
    r = np.random.default_rng(3)
    for most in (1, 2, 5):
        arr = np.sort(r.integers(0, 4000, 60))
        got, recent = ev.admissions(arr, [], most, 100)
        assert got.tolist() == start_times(arr.tolist(), most, 100)
        assert recent == got.tolist()[-most:]
        first, state = ev.admissions(arr[:25], [], most, 100)           # in two batches
        second, _ = ev.admissions(arr[25:], state, most, 100)
        assert first.tolist() + second.tolist() == got.tolist()


def _ordered_files(pdf, parts):
    """Event files that arrive in time order (distinct modification times)."""
    import time
    import pyarrow as pa
    import pyarrow.parquet as pq
    d = tempfile.mkdtemp(prefix="vecdex-ev-")
    os.makedirs(os.path.join(d, "events"))
    chunks = np.array_split(pdf, parts)
    for i, c in enumerate(chunks):
        pq.write_table(pa.Table.from_pandas(c, preserve_index=False),
                       os.path.join(d, "events", f"part-{i}.parquet"), coerce_timestamps="us")
        time.sleep(0.05)
    return os.path.join(d, "events"), chunks


def test_limiter_stream(spark):
    pdf = _events(spark, n=200, users=2)
    path, _ = _ordered_files(pdf, 4)
    src = st.file_stream(spark, path)
    out = ev.limiter_replay_stream(src, "user_id", "ts", "event_id", 2, 30.0)
    sink, ck = scratch_path(spark, "t-st4"), scratch_path(spark, "t-st4c")
    (out.writeStream.outputMode("append").format("parquet").option("path", sink)
     .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(sink).toPandas()
    assert len(got) == len(pdf)
    for u, g in got.groupby("user_id"):
        g = g.sort_values(["arrival", "event_id"])
        us = (g["arrival"].to_numpy() * 1e6).round().astype(np.int64)
        assert np.allclose(g["admitted"], np.array(start_times(us.tolist(), 2, 30_000_000)) / 1e6)


def test_debounce_stream_equals_batch_on_closed_sessions(spark):
    import time
    import pyarrow as pa
    import pyarrow.parquet as pq
    d = tempfile.mkdtemp(prefix="vecdex-ev-")
    pdf = _events(spark)
    chunks = np.array_split(pdf, 4)                    # arrive in time order
    os.makedirs(os.path.join(d, "events"))
    for i, c in enumerate(chunks):
        pq.write_table(pa.Table.from_pandas(c, preserve_index=False),
                       os.path.join(d, "events", f"part-{i}.parquet"), coerce_timestamps="us")
        time.sleep(0.05)
    src = st.file_stream(spark, os.path.join(d, "events"))
    agg = ev.debounce_stream(src, "user_id", "ts", "20 seconds", watermark="0 seconds")
    sink, ck = scratch_path(spark, "t-st3"), scratch_path(spark, "t-st3c")
    (agg.writeStream.outputMode("append").format("parquet").option("path", sink)
     .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    streamed = {r["event_id"] for r in spark.read.parquet(sink).collect()}
    batch = brute_debounce(pdf, 20_000)
    assert streamed <= batch
    # sessions still open under the final watermark are withheld (append mode);
    # the watermark before the last file is the max event time of the others
    wm = max(c["ts"].max() for c in chunks[:-1])
    ts_of = dict(zip(pdf["event_id"], pdf["ts"]))
    closed = {e for e in batch if ts_of[e] + pd.Timedelta(seconds=21) < wm}
    assert closed <= streamed


def test_stream_search_equals_batch(spark):
    conv = spark.read.parquet(os.path.join(SF_ORACLE, "conversations.parquet"))
    idx = embed.HashingEmbedder(32).embed(
        spark.read.parquet(os.path.join(SF_ORACLE, "documents.parquet"))
        .select(F.col("doc_id").alias("id"), "text"), "text")
    q_batch = conv.select((F.col("conv_id") * 100 + F.col("turn")).alias("qid"),
                          F.col("text").alias("query"), F.lit(5).alias("limit"))
    batch = search.search_hits(q_batch, idx, embed.HashingEmbedder(32), 32)
    s = st.file_stream(spark, os.path.join(SF_ORACLE, "conversations.parquet"))
    q_stream = s.select((F.col("conv_id") * 100 + F.col("turn")).alias("qid"),
                        F.col("text").alias("query"), F.lit(5).alias("limit"))
    streamed = st.search_stream_results(spark, q_stream, idx, embed.HashingEmbedder(32), 32)
    assert sorted(map(tuple, streamed.select(*batch.columns).collect())) == \
        sorted(map(tuple, batch.collect()))


def test_debounce_needs_two_characters(spark):
    df = spark.createDataFrame([(1, 1, 0, "a"), (2, 1, 5, "ab"), (3, 2, 0, " x "), (4, 3, 0, "xy")], "event_id int, user_id int, s int, q string")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    got = [r.event_id for r in ev.debounce(df, "user_id", "ts", 0.3, tie="event_id", query_col="q").collect()]
    assert sorted(got) == [2, 4]
    assert ev.debounce(df, "user_id", "ts", 0.3).count() == 4


@pytest.fixture(scope="module")
def shuffled_events():
    """The events dealt at random over files, the latest of them read first."""
    import time
    import pyarrow as pa
    import pyarrow.parquet as pq
    d = tempfile.mkdtemp(prefix="vecdex-ev-")
    os.makedirs(os.path.join(d, "events.parquet"))
    rows = pq.read_table(os.path.join(SF_ORACLE, "events.parquet"))
    part = np.random.default_rng(8).integers(0, 5, len(rows))
    part[np.argmax(rows["ts"].to_numpy())] = 0
    for i in range(5):
        pq.write_table(rows.filter(pa.array(part == i)), os.path.join(d, "events.parquet", f"part-{i}.parquet"))
        time.sleep(0.05)
    return d


@pytest.mark.parametrize("key", ["st3_debounce_stream", "st4_replay_stream"])
def test_streams_over_files_without_time_order(spark, shuffled_events, key):
    import duckdb
    import __spark_entry__ as E
    got = E.queries()[key](spark, shuffled_events).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_ORACLE}/events.parquet')")
    want = con.execute(E.oracle_sql()[key]).df()
    order = lambda p: p[sorted(p.columns)].sort_values("event_id", ignore_index=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)


def test_debounce_stream_flushed_equals_batch(spark, shuffled_events):
    path = os.path.join(shuffled_events, "events.parquet")
    agg = ev.debounce_stream(st.file_stream(spark, path, max_files=None), "user_id", "ts", "1 hour")
    out = ev.run_debounce_stream(agg, sink=scratch_path(spark, "t-flush"), checkpoint=scratch_path(spark, "t-flushc"), flush=True)
    got = sorted(r.event_id for r in out.collect())
    batch = ev.debounce(spark.read.parquet(path), "user_id", "ts", 3600.0, tie="event_id")
    assert got == sorted(r.event_id for r in batch.collect())
    appended = ev.run_debounce_stream(agg, sink=scratch_path(spark, "t-app"), checkpoint=scratch_path(spark, "t-appc"))
    assert appended.count() < len(got)


@pytest.mark.parametrize("key", ["st3_timer_stream", "st4_timer_audit"])
def test_timer_streams_over_files_without_time_order(spark, shuffled_events, key):
    import duckdb
    import __spark_entry__ as E
    got = E.queries()[key](spark, shuffled_events).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_ORACLE}/events.parquet')")
    want = con.execute(E.oracle_sql()[key]).df()
    order = lambda p: p[sorted(p.columns)].sort_values("event_id", ignore_index=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)


def _state_rows(spark, checkpoint):
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "rows").load()


def test_timers_fire_as_the_watermark_moves(spark):
    """Files in time order, one a micro-batch: most events are emitted on the way,
    the state holds the rest only, and all of it together is the batch answer."""
    from vecdex.streaming import timers
    pdf = _events(spark)
    path, _ = _ordered_files(pdf, 4)
    for make, brute in ((lambda s: timers.debounce_timers(s, "user_id", "ts", 20.0, watermark="1 second", bucket_seconds=300.0), None),
                        (lambda s: timers.audit_timers(s, "user_id", "ts", 30.0, 2, watermark="1 second", bucket_seconds=300.0), "rate")):
        sink, ck = scratch_path(spark, "t-timers"), scratch_path(spark, "t-timersc")
        rows = make(st.file_stream(spark, path)).run(sink, ck).collect()
        early = {r.event_id for r in spark.read.parquet(os.path.join(sink, "decided")).collect()}
        assert len(rows) == len({r.event_id for r in rows})
        if brute:
            assert {r.event_id: r.n_window for r in rows} == brute_rate(pdf, 30_000)
            assert all(r.over_limit == (r.n_window > 2) for r in rows)
        else:
            assert {r.event_id for r in rows} == brute_debounce(pdf, 20_000)
        assert len(early) > 0.6 * len(rows)
        assert _state_rows(spark, ck).count() < 0.35 * len(pdf)


def test_timer_streams_edges(spark):
    """A hot key over many buckets, equal times, an event at a bucket's edge, no events."""
    from vecdex.streaming import timers
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(seconds=10 * k), 1) for k in range(200)] + [(900, t0 + dt.timedelta(seconds=600), 2), (901, t0 + dt.timedelta(seconds=600), 2),
                                                                             (902, t0 + dt.timedelta(seconds=599), 2)]
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id"])
    path, _ = _ordered_files(pdf, 1)
    src = st.file_stream(spark, path, max_files=None)
    for gap in (10.0, 10.000001):
        out = timers.debounce_timers(src, "user_id", "ts", gap, bucket_seconds=60.0).run(scratch_path(spark, "t-e"), scratch_path(spark, "t-ec"))
        want = ev.debounce(spark.createDataFrame(pdf), "user_id", "ts", gap, tie="event_id")
        assert sorted(r.event_id for r in out.collect()) == sorted(r.event_id for r in want.collect())
    empty = scratch_path(spark, "t-none")
    spark.createDataFrame(pdf).limit(0).write.parquet(empty)
    out = timers.audit_timers(st.file_stream(spark, empty), "user_id", "ts", 5.0, 1).run(scratch_path(spark, "t-n"), scratch_path(spark, "t-nc"))
    assert out.count() == 0


def test_timer_streams_share_states_among_keys(spark):
    """Many keys in few states, with nulls in every column but the first: numbers keep
    their digits, and rows without a time or a key are decided like the batch forms'."""
    from vecdex.streaming import timers
    t0, big = dt.datetime(2024, 1, 1), 2 ** 53 + 1
    rows = [(big + k, None if k % 11 == 0 else t0 + dt.timedelta(seconds=(k * 37) % 900), None if k % 13 == 0 else big + k % 40,
             None if k % 7 == 0 else big + 2 * k, (None, float("nan"), 0.5)[k % 3], None if k % 5 == 0 else k % 2 == 0,
             None if k % 3 == 0 else t0, None if k % 4 == 0 else f"x{k}") for k in range(600)]
    path = scratch_path(spark, "t-shared")
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, n long, v double, b boolean, seen timestamp, s string").write.parquet(path)
    events = spark.read.parquet(path)
    src = st.file_stream(spark, path, max_files=None)
    for make, want in ((lambda: timers.debounce_timers(src, "user_id", "ts", 20.0, bucket_seconds=300.0, slots=2),
                        ev.debounce(events, "user_id", "ts", 20.0, tie="event_id")),
                       (lambda: timers.audit_timers(src, "user_id", "ts", 30.0, 2, bucket_seconds=300.0, slots=2),
                        ev.rate_audit(events, "user_id", "ts", 30.0, 2))):
        ck = scratch_path(spark, "t-sharedc")
        got = make().run(scratch_path(spark, "t-shared-sink"), ck)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        states = _state_rows(spark, ck).select("key.*").distinct()
        assert states.count() <= 2 * 5  # three buckets, one before or after them, one without time
