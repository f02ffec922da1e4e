"""Token ids in binary files, coded by a static range asymmetric numeral system.

Format, a folder of three parquet tables that Spark writes and reads:

* ``table``: the shared frequency table, ``token, freq``; the frequencies of
  all tokens that occur sum to 2^20;
* ``blocks``: independent blocks of whole documents in ascending id order.
  Symbol *i* of a block goes to lane *i mod lanes*; the lanes interleave their
  32-bit words in one stream (``payload``). ``states`` holds the lanes' states
  at the start of the block and at each checkpoint, ``words`` the stream
  positions that belong to them, so any segment between checkpoints can be
  decoded alone. ``crc32`` checks the decoded ids;
* ``starts``: ids before each part of ``blocks``, one row per part.

Writing takes three steps: encode the texts with the ``tokenizers`` library
and count tokens per task, add the counts up (a row per task and token, then a
row per token), and sort by id and code the blocks. Nothing but the frequency
table, bounded by the vocabulary, and one number per part reach the driver or
a broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.llm.tokens import encoder, vocabulary
from vecdex.session import scratch_path

SCALE = 20
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK32 = np.uint64((1 << 32) - 1)
#: ids after which a block is closed; lanes of a full block; rows of lanes between checkpoints
BLOCK, LANES, EVERY = 1 << 20, 2048, 256


def quantised(counts: dict[int, int]) -> dict[int, int]:
    """Counts as frequencies that sum to 2^SCALE, at least 1 each."""
    if not counts:
        return {}
    total, whole = sum(counts.values()), 1 << SCALE
    if len(counts) > whole:
        raise ValueError(f"more than {whole} distinct tokens")
    freq = {t: max(1, c * whole // total) for t, c in counts.items()}
    spare = whole - sum(freq.values())
    for token in sorted(freq, key=lambda t: (-freq[t], t)):  # the commonest pay or gain
        change = spare if spare > 0 else max(spare, 1 - freq[token])
        freq[token] += change
        spare -= change
        if not spare:
            break
    return freq


class Model:
    """The shared table as arrays: frequency and first slot per token, token per slot."""

    def __init__(self, tokens: np.ndarray, freqs: np.ndarray):
        order = np.argsort(tokens)
        tokens, freqs = tokens[order].astype(np.int64), freqs[order].astype(np.int64)
        self.freq = np.zeros(int(tokens[-1]) + 1 if len(tokens) else 1, np.uint64)
        self.first = np.zeros_like(self.freq)
        self.freq[tokens] = freqs
        self.first[tokens] = np.cumsum(freqs) - freqs
        self.slot = np.repeat(tokens, freqs).astype(np.uint32)


@dataclass
class Block:
    n: int
    lanes: int
    payload: bytes
    states: bytes
    words: list[int]
    crc32: int


def encode_block(ids: np.ndarray, model: Model, lanes: int = LANES, every: int = EVERY) -> Block:
    """Code one block, last symbol first. ``ids`` may be empty."""
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    state = np.full(lanes, _LOW)
    chunks, saved, marks, written = [], [], [], 0
    scale, room = np.uint64(SCALE), np.uint64(63 - SCALE)
    for row in range(-(-n // lanes) - 1, -1, -1):
        symbol = ids[row * lanes:(row + 1) * lanes]
        x, f = state[:len(symbol)], model.freq[symbol]
        full = (x >> room) >= f
        out = (x[full] & _MASK32).astype("<u4")
        x = np.where(full, x >> _WORD, x)
        quotient = x // f
        state[:len(symbol)] = (quotient << scale) + (x - quotient * f) + model.first[symbol]
        chunks.append(out)
        written += len(out)
        if row % every == 0:
            saved.append(state.copy())
            marks.append(written)
    if not saved:
        saved, marks = [state], [0]
    payload = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    return Block(n, lanes, payload.tobytes(), np.concatenate(saved[::-1]).astype("<u8").tobytes(),
                 [written - m for m in marks[::-1]], zlib.crc32(ids.astype("<u4").tobytes()))


def decode_segment(block: Block, model: Model, k: int, every: int = EVERY) -> np.ndarray:
    """The ids between checkpoints ``k`` and ``k + 1`` as unsigned 32-bit numbers."""
    lanes, begin = block.lanes, k * every
    rows = min(-(-block.n // lanes), begin + every)
    state = np.frombuffer(block.states, "<u8")[k * lanes:(k + 1) * lanes].astype(np.uint64)
    words = np.frombuffer(block.payload, "<u4")
    at, scale, low = block.words[k], np.uint64(SCALE), np.uint64((1 << SCALE) - 1)
    out = np.empty(min(block.n, rows * lanes) - begin * lanes if block.n else 0, np.uint32)
    for row in range(begin, rows):
        here = slice((row - begin) * lanes, min((row + 1) * lanes, block.n) - begin * lanes)
        x = state[:here.stop - here.start]
        slot = x & low
        symbol = model.slot[slot]
        out[here] = symbol
        x = model.freq[symbol] * (x >> scale) + slot - model.first[symbol]
        empty = x < _LOW
        take = int(np.count_nonzero(empty))
        x[empty] = x[empty] << _WORD | words[at:at + take]
        at += take
        state[:len(x)] = x
    return out


def decode_block(block: Block, model: Model, every: int = EVERY) -> np.ndarray:
    """All ids of a block; raises where they do not match the checksum."""
    ids = np.concatenate([decode_segment(block, model, k, every) for k in range(len(block.words))])
    if zlib.crc32(ids.astype("<u4").tobytes()) != block.crc32:
        raise ValueError("a block's ids do not match its checksum")
    return ids


_TOKENS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                        T.StructField("counts", T.BinaryType())])


def _squeeze(ids: np.ndarray, narrow: bool) -> bytes:
    """Ids for the way to the sort: byte planes, compressed."""
    import zstandard
    data = ids.astype("<u2" if narrow else "<u4")
    planes = np.ascontiguousarray(data.view(np.uint8).reshape(len(data), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unsqueeze(data: bytes, n: int, narrow: bool) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2 if narrow else 4, n)
    return np.ascontiguousarray(planes.T).view("<u2" if narrow else "<u4").ravel()


def _encode_texts(docs: DataFrame, id_col: str, text_col: str, vocab: str, end_id: int, narrow: bool) -> DataFrame:
    """A row per document, and a last row per task with its token counts."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *_TOKENS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts = encoder(vocab).encode, np.zeros(1, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                n, data = [], []
                for text in batch.column(1).to_pylist():
                    ids = np.append(np.frombuffer(encode(text or ""), "<u4"), np.uint32(end_id))
                    data.append(ids)
                    n.append(len(ids))
                own = np.bincount(np.concatenate(data))
                if len(own) > len(counts):
                    counts = np.pad(counts, (0, len(own) - len(counts)))
                counts[:len(own)] += own
                blobs = [_squeeze(ids, narrow) for ids in data]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(blobs, pa.binary()),
                     pa.nulls(batch.num_rows, pa.binary())], schema.names)
        if counts.any():
            yield pa.RecordBatch.from_pylist(
                [{"counts": counts.astype("<i8").tobytes()}], pa.schema(
                    [(schema.names[0], _arrow_type(schema[0].dataType)), ("n_tokens", pa.int64()),
                     ("ids", pa.binary()), ("counts", pa.binary())]))

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for data in batch.column(0).to_pylist():
            own = np.frombuffer(data, "<i8")
            if len(own) > len(total):
                total = np.pad(total, (0, len(own) - len(total)))
            total[:len(own)] += own
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "n"])


def write_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                vocab: str | None = None, end_id: int = 0, block: int = BLOCK) -> None:
    """Write all texts of ``docs`` under ``path`` in ascending id order, nulls first.

    Null text counts as empty: its document holds the end id alone. Rows that
    share an id stand next to each other; an empty table gives empty files.
    Other columns are not read.
    """
    spark = docs.sparkSession
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    narrow = _vocabulary_size(vocab) <= 1 << 16 and 0 <= end_id < 1 << 16
    staged = scratch_path(spark, "token-ids")
    (_encode_texts(docs, id_col, text_col, vocab, end_id, narrow)
     .write.option("compression", "none").parquet(staged))
    tokens = spark.read.parquet(staged)
    counts = (tokens.where(F.col("counts").isNotNull()).select("counts")
              .mapInArrow(_sum_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    freq = quantised({r.token: r.n for r in counts.collect()})  # bounded by the vocabulary
    spark.createDataFrame([(int(t), int(f)) for t, f in freq.items()], "token long, freq long").coalesce(1).write.parquet(
        f"{path}/table")
    _write_blocks(tokens, path, freq, narrow, block)
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(  # one row per part
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    starts.coalesce(1).write.parquet(f"{path}/starts")


def _vocabulary_size(vocab: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocab).get_vocab_size(with_added_tokens=True)


def _write_blocks(tokens: DataFrame, path: str, freq: dict[int, int], narrow: bool, block: int) -> None:
    names = np.fromiter(freq.keys(), np.int64, len(freq))
    values = np.fromiter(freq.values(), np.int64, len(freq))
    kind = tokens.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("lanes", T.IntegerType()),
        T.StructField("payload", T.BinaryType()), T.StructField("states", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.LongType())), T.StructField("crc32", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, first = Model(names, values), TaskContext.get().partitionId(), 0
        keys, lengths, ids, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            b = encode_block(np.concatenate(ids), model)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first]), pa.array([b.n]), pa.array([b.lanes], pa.int32()),
                pa.array([b.payload]), pa.array([b.states]), pa.array([b.words], pa.list_(pa.int64())),
                pa.array([b.crc32], pa.int64()), pa.array([keys], pa.list_(_arrow_type(kind))),
                pa.array([lengths], pa.list_(pa.int64()))], schema.names)

        for batch in batches:
            for key, n, data in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                keys.append(key)
                lengths.append(n)
                ids.append(_unsqueeze(data, n, narrow))
                held += n
                if held >= block:
                    yield close()
                    first += held
                    keys, lengths, ids, held = [], [], [], 0
        if ids:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.xxhash64("ids"), F.col("ids")]
    (tokens.where(F.col("ids").isNotNull()).select("doc_id", "n_tokens", "ids")
     .repartitionByRange(*order[:3]).sortWithinPartitions(*order)
     .mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks"))


@lru_cache(maxsize=2)
def _model(names: bytes, values: bytes) -> Model:
    return Model(np.frombuffer(names, np.int64), np.frombuffer(values, np.int64))


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """A row per document from the files: ``doc_id, start, n_tokens, ids_crc32``
    and, with ``with_ids``, ``ids``. Blocks are decoded independently."""
    table = spark.read.parquet(f"{path}/table").collect()  # bounded by the vocabulary
    names = np.array([r.token for r in table], np.int64).tobytes()
    values = np.array([r.freq for r in table], np.int64).tobytes()
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(names, values)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(Block(row["n_tokens"], row["lanes"], row["payload"], row["states"],
                                         row["words"], row["crc32"]), model).astype("<u4")
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                begins = ends - row["lengths"]
                own = [ids[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(row["doc_ids"], _arrow_type(kind)), pa.array(begins + row["start"] + row["first"]),
                        pa.array(row["lengths"], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    starts = F.broadcast(spark.read.parquet(f"{path}/starts"))  # one row per part file
    return blocks.join(starts, "part").mapInArrow(run, T.StructType(fields))
