"""ST3 and ST4 as streams with timers and expiring state (``transformWithState``).

State is kept per (slot, time bucket), with the rows near a bucket's edge copied
into the neighbouring bucket as context, as the batch forms do. A slot holds the keys
of one hash value: a state's calls cost the same for one event as for thousands, so
``slots`` follows the events (``slots_for``) and a state holds a bounded number of
them, beside those of a key that has more by itself. A state keeps its rows as Arrow
record batches, and null numbers travel as a value and a flag, as pandas would turn
the other rows' numbers into floats.

* Debounce: an event waits in the state until the watermark has passed its time
  plus the gap; a timer then emits it unless another event of its key came less
  than the gap after it. What has been decided leaves the state.
* Rate audit: an event waits until the watermark has passed it, so that every
  event of its trailing window is known; it leaves once no later window can reach
  it.

Neither needs files in time order beyond the watermark's delay. At the end of a
bounded input ``finish`` decides what still waits, read from the state itself.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vecdex.streaming.events import _US, _bucket, _with_context, event_micros, event_time

#: columns beside the events' own
US, BUCKET, OWN, DONE, AFTER, SLOT, NULLS, CODE = (f"vecdex_{name}" for name in ("us", "bucket", "own", "done", "after", "slot", "nulls", "code"))
#: slots unless told otherwise; events of a slot over all time; rows of one packed batch
SLOTS, SLOT_ROWS, PACK_ROWS = 64, 10_000, 10_000
#: bucket of the rows without a time: a null in a state's key would turn it to a float
NEVER = -(1 << 62)
_PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def slots_for(rows: int) -> int:
    """Slots for a stream of about so many events."""
    return max(1, -(-rows // SLOT_ROWS))


def _flagged(schema: T.StructType) -> list[T.StructField]:
    """The columns that travel as a value and a flag."""
    kinds = (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType, T.TimestampType)
    return [f for f in schema.fields if isinstance(f.dataType, kinds)]


def _plain(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` as pandas can hold them, and ``NULLS``."""
    flagged = _flagged(schema)
    flags = F.concat(F.lit(""), *[F.when(F.col(f.name).isNull(), "1").otherwise("0") for f in flagged])
    value = {f.name: F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in flagged}
    zero = {f.name: F.lit(False) if isinstance(f.dataType, T.BooleanType) else F.lit(0) for f in flagged}
    return df.withColumn(NULLS, flags).withColumns({
        f.name: F.coalesce(value[f.name], zero[f.name].cast("long" if isinstance(f.dataType, T.TimestampType) else f.dataType)) for f in flagged})


def _restored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` as they were before ``_plain``."""
    back = {}
    for k, f in enumerate(_flagged(schema)):
        value = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = F.coalesce(value, F.lit(float("nan")).cast(f.dataType))  # pandas takes it for null
        elif isinstance(f.dataType, T.TimestampType):
            value = F.timestamp_micros(value)
        back[f.name] = F.when(F.substring(NULLS, k + 1, 1) == "0", value)
    return df.withColumns(back) if back else df


def debounced(rows: pd.DataFrame, gap_us: int, by: list[str]) -> pd.Series:
    """Which rows have no other of their key less than the gap after them (``by``
    orders rows of one time)."""
    order = rows.sort_values([CODE, US, *by], kind="stable")
    after = order[US].shift(-1) - order[US]
    return ((order[CODE] != order[CODE].shift(-1)) | (after >= gap_us)).reindex(rows.index)


def counted(rows: pd.DataFrame, window_us: int) -> pd.Series:
    """How many rows of its key lie in each row's trailing window, both ends included."""
    n, us = len(rows), rows[US].to_numpy()
    rank = np.unique(np.concatenate([us, us - window_us]), return_inverse=True)[1]
    base = rows[CODE].to_numpy(np.int64) * (2 * n + 1)
    mine, since = base + rank[:n], base + rank[n:]
    placed = np.sort(mine)
    return pd.Series(placed.searchsorted(mine, "right") - placed.searchsorted(since, "left"), rows.index)


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> Iterator[tuple[bytes]]:
    for start in range(0, len(rows), PACK_ROWS):
        batch = pa.RecordBatch.from_pandas(rows.iloc[start:start + PACK_ROWS], schema=schema, preserve_index=False)
        yield (batch.serialize().to_pybytes(),)


def _unpacked(packed: bytes, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(bytes(packed)), schema)


class _Waiting(StatefulProcessor):
    """Rows of one slot's keys wait in a list; a timer decides those that are due and
    keeps the rest that is still needed. Rows without a time wait to the end."""

    def __init__(self, key: str, key_flag: int | None, schema: pa.Schema, out: list[str]):
        self.key, self.key_flag, self.schema, self.out = key, key_flag, schema, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", _PACKED)

    def due(self, rows: pd.DataFrame) -> pd.Series:
        """First microsecond at which each row may be decided."""
        raise NotImplementedError

    def decide(self, rows: pd.DataFrame, now_us: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """What is emitted at the watermark ``now_us``, and what stays."""
        raise NotImplementedError

    def _ring(self, rows: pd.DataFrame) -> None:
        """One timer: for the next row to be decided."""
        waiting = rows[rows[OWN] & ~rows[DONE]]
        if waiting.empty:
            return
        at, set_ = int(self.due(waiting).min()) // 1000 + 1, list(self.handle.listTimers())
        if not set_ or at < min(set_):
            for t in set_:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for fresh in rows:
            for packed in _packed(fresh[self.schema.names], self.schema):
                self.rows.appendValue(packed)
            if key[1] != NEVER:
                self._ring(fresh)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = pa.Table.from_batches([_unpacked(r[0], self.schema) for r in self.rows.get()], self.schema).to_pandas()
        by = [self.key] if self.key_flag is None else [rows[self.key], rows[NULLS].str[self.key_flag]]
        rows[CODE] = rows.groupby(by, sort=False, dropna=False).ngroup()
        emitted, stay = self.decide(rows, timerValues.getCurrentWatermarkInMs() * 1000)
        self.rows.clear()
        for packed in _packed(stay[self.schema.names], self.schema):
            self.rows.appendValue(packed)
        self.handle.deleteTimer(expiredTimerInfo.getExpiryTimeInMs())
        self._ring(stay)
        if len(emitted):
            yield emitted[self.out]

    def close(self) -> None:
        pass


class _Debounce(_Waiting):
    def __init__(self, key, key_flag, schema, out, gap_us: int, tie: str, tie_flag: int | None):
        super().__init__(key, key_flag, schema, out)
        self.gap, self.tie, self.tie_flag = gap_us, tie, tie_flag

    def due(self, rows):
        return rows[US] + self.gap

    def decide(self, rows, now_us):
        by = [self.tie] if self.tie_flag is None else [AFTER, self.tie]  # nulls last
        if self.tie_flag is not None:
            rows = rows.assign(**{AFTER: rows[NULLS].str[self.tie_flag]})
        ready = self.due(rows) <= now_us
        return rows[ready & rows[OWN] & debounced(rows, self.gap, by)], rows[~ready]


class _Audit(_Waiting):
    def __init__(self, key, key_flag, schema, out, window_us: int, most: int):
        super().__init__(key, key_flag, schema, out)
        self.window, self.most = window_us, most

    def due(self, rows):
        return rows[US]

    def decide(self, rows, now_us):
        n = counted(rows, self.window)
        ready = (rows[US] <= now_us) & ~rows[DONE]
        out = rows[ready & rows[OWN]].assign(n_window=n, over_limit=n > self.most)
        stay = rows.assign(**{DONE: rows[DONE] | ready})
        return out, stay[stay[US] + self.window >= now_us]


class TimedStream:
    """A stream of decisions and its final step; see ``debounce_timers`` and
    ``audit_timers``."""

    def __init__(self, decided: DataFrame, rest: Callable[[DataFrame], DataFrame]):
        self.decided, self._rest = decided, rest

    def run(self, sink: str, checkpoint: str) -> DataFrame:
        """Run over the input there is, then decide what still waits; all of it."""
        spark = self.decided.sparkSession
        before = {k: spark.conf.get(k, None) for k in _SETTINGS}
        for k, v in _SETTINGS.items():
            spark.conf.set(k, v)
        try:
            query = (self.decided.writeStream.outputMode("append").format("parquet").option("path", os.path.join(sink, "decided"))
                     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
            query.awaitTermination()
            self.finish(spark, checkpoint).write.mode("overwrite").parquet(os.path.join(sink, "rest"))
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        done = spark.read.schema(self.decided.schema).parquet(os.path.join(sink, "decided"))
        return done.unionByName(spark.read.schema(self.decided.schema).parquet(os.path.join(sink, "rest")))

    def finish(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """Decisions on the rows that wait in the state of a stream that has ended."""
        state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "rows").load())
        return self._rest(state.select(F.col(f"key.{BUCKET}").alias(BUCKET), F.col("list_element.packed").alias("packed")))


def _flag(schema: T.StructType, name: str) -> int | None:
    names = [f.name for f in _flagged(schema)]
    return names.index(name) if name in names else None


def _stream(events: DataFrame, key: str, ts: str, span_us: int, bucket_us: int, direction: int, watermark: str, slots: int,
            extra: list[T.StructField], processor: Callable[..., StatefulProcessor]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The decisions, and what reads the rows of a state back."""
    schema = events.schema
    timed = events.withColumn("_time", event_time(events, ts)).withWatermark("_time", watermark)
    tagged = (_with_context(timed, event_micros(events, ts), span_us, bucket_us, direction).withColumn(DONE, F.lit(False))
              .withColumnsRenamed({"_us": US, "_b": BUCKET, "_own": OWN})
              .withColumn(US, F.coalesce(US, F.lit(0).cast("long"))).withColumn(BUCKET, F.coalesce(BUCKET, F.lit(NEVER)))
              .withColumn(SLOT, F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")))
    plain = _plain(tagged, schema)
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in plain.schema.fields if f.name not in (SLOT, BUCKET, "_time")])
    arrow = to_arrow_schema(kept)
    out = T.StructType([*[f for f in kept.fields if f.name not in (US, OWN, DONE)], *extra])
    decided = plain.groupBy(SLOT, BUCKET).transformWithStateInPandas(
        processor(key, _flag(schema, key), arrow, out.names), outputStructType=out, outputMode="Append", timeMode="EventTime")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, packed in zip(batch[0].to_pylist(), batch[1], strict=True):
                rows = _unpacked(packed.as_py(), arrow)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([bucket] * len(rows), pa.int64())], [*rows.schema.names, BUCKET])

    def waiting(state: DataFrame) -> DataFrame:
        rows = state.mapInArrow(unpack, T.StructType([*kept.fields, T.StructField(BUCKET, T.LongType())]))
        return _restored(rows, schema).withColumn(US, F.when(F.col(BUCKET) != NEVER, F.col(US)))

    return _restored(decided, schema).select(*schema.names, *[f.name for f in extra]), waiting


def debounce_timers(events: DataFrame, key: str, ts: str, gap_seconds: float, *, tie: str = "event_id",
                    watermark: str = "10 minutes", bucket_seconds: float | None = None, slots: int = SLOTS) -> TimedStream:
    """ST3: events of ``key`` that no other follows within the gap, each emitted once
    the watermark has passed its time plus the gap."""
    gap = int(round(gap_seconds * _US))
    flag = _flag(events.schema, tie)
    decided, waiting = _stream(events, key, ts, gap, _bucket(gap, bucket_seconds), -1, watermark, slots, [],
                               lambda *a: _Debounce(*a, gap, tie, flag))

    def rest(state: DataFrame) -> DataFrame:
        rows = waiting(state)
        after = F.lead(US).over(Window.partitionBy(key, BUCKET).orderBy(US, tie))
        return (rows.withColumn(AFTER, after).where(F.col(OWN) & (F.col(AFTER).isNull() | (F.col(AFTER) >= F.col(US) + gap)))
                .select(*decided.columns))
    return TimedStream(decided, rest)


def audit_timers(events: DataFrame, key: str, ts: str, window_seconds: float, max_events: int, *,
                 watermark: str = "10 minutes", bucket_seconds: float | None = None, slots: int = SLOTS) -> TimedStream:
    """ST4: every event with the number of its key's events in the trailing window,
    emitted once the watermark has passed it; state expires a window later."""
    span = int(round(window_seconds * _US))
    extra = [T.StructField("n_window", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    decided, waiting = _stream(events, key, ts, span, _bucket(span, bucket_seconds), 1, watermark, slots, extra,
                               lambda *a: _Audit(*a, span, max_events))

    def rest(state: DataFrame) -> DataFrame:
        rows = waiting(state)
        n = F.count(F.lit(1)).over(Window.partitionBy(key, BUCKET).orderBy(US).rangeBetween(-span, 0))
        return (rows.withColumn("n_window", n).where(F.col(OWN) & ~F.col(DONE))
                .withColumn("over_limit", F.col("n_window") > max_events).select(*decided.columns))
    return TimedStream(decided, rest)
