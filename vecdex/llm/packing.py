"""Best-fit packing by minimum bin slack.

Documents are encoded, closed with an end id, cut into pieces of at most
``capacity`` tokens, and the pieces are packed into as few sequences as the
method finds.

Minimum bin slack fills one bin at a time: the longest length left goes in,
then a bitset subset-sum over the lengths left (bit *s* is set if some
feasible choice of pieces sums to *s*) finds the choice that leaves the least
slack; those pieces are removed and the next bin is filled. The plan needs
only how many pieces of each length exist, at most ``capacity`` numbers
whatever the corpus size, and a combination is applied as often as its
lengths last, so each step uses up at least one length: a plan has about as
many steps as there are lengths. Spark does the rest: pieces are ranked within
their length and the rank picks the slot. A length that holds a third of all
pieces is ranked in hash buckets whose sizes are prefix-summed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.llm.common import fresh
from vecdex.llm.tokens import MEMO_LIMIT, encoder, vocabulary
from vecdex.session import cut_lineage

CAPACITY = 2048
#: pieces of one length that are ranked together in one task
RANK_ROWS = 1000


def document_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    vocab: str | None = None, end_id: int = 0, capacity: int = CAPACITY,
                    with_ids: bool = False, known: int = MEMO_LIMIT) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, with
    ``with_ids``, the ids themselves.

    A null text counts as empty and gives one piece that holds the end id
    alone; repeated rows and null ids give pieces like any other row. Columns
    other than the two named ones are not read. A worker remembers the ids of
    up to ``known`` pieces of text, about 0.2 kB each.
    """
    vocab = vocab or vocabulary("word_bpe_49k.json")
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType),
              T.StructField("piece", T.IntegerType(), False), T.StructField("start", T.LongType(), False),
              T.StructField("length", T.LongType(), False), T.StructField("ids_crc32", T.LongType(), False)]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    end = int(end_id).to_bytes(4, "little")
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab, known).encode
        for batch in batches:
            keys, rows, piece, length, crc, ids = batch.column(0), [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = encode(text or "") + end
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at:at + width]
                    rows.append(row)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            index = np.array(piece, np.int64)
            cols = [keys.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(index * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, T.StructType(fields))


@dataclass
class Slots:
    """Where the pieces of each length go: ranks ``[first, first + bins * copies)``
    of ``length`` fill ``copies`` places in each of ``bins`` sequences."""

    length: np.ndarray
    first: np.ndarray
    bins: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length to take so that ``room`` is left with the
    least slack. Bit s of ``reach`` says that some choice sums to s."""
    reach, mask, trail = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        before, most, step = reach, min(counts[length], room // length), 1
        while most > 0:  # copies in powers of two reach every multiple up to most
            step = min(step, most)
            reach |= (reach << (length * step)) & mask
            most -= step
            step *= 2
        trail.append((length, before))
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        while not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return taken


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[Slots, int]:
    """Minimum bin slack over a length histogram; also the number of bins."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    rows, sequences = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        taken = fullest({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        bins = min(left[n] // k for n, k in taken.items())
        offset = 0
        for n in sorted(taken, reverse=True):
            rows.append((n, used[n], bins, sequences, offset))
            used[n] += bins * taken[n]
            offset += n * taken[n]
            left[n] -= bins * taken[n]
            if not left[n]:
                del left[n]
        sequences += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Slots(*(np.ascontiguousarray(table[:, k]) for k in range(5))), sequences


def pack(pieces: DataFrame, length_col: str = "length", order_by: tuple[str, ...] = ("doc_id", "piece"),
         capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (both long).

    Every row gets a place; sequences are filled without gaps from offset 0.
    A length that is null, below 1 or above ``capacity`` raises. Rows that tie
    in ``order_by`` are told apart by their whole content; equal rows may
    swap places. An empty input gives an empty result. Input columns named like
    the two new ones are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    rank, bucket = fresh(pieces, "rank"), fresh(pieces, "bucket")
    size = F.col(length_col).cast("long")
    staged = cut_lineage(pieces.withColumn(length_col, F.when(size.between(1, capacity), size).otherwise(
        F.raise_error(F.lit(f"a piece must hold 1 to {capacity} tokens")).cast("long"))))
    # at most `capacity` rows come back, however many pieces there are
    histogram = {r[0]: r[1] for r in staged.groupBy(length_col).count().collect()}
    slots, _ = plan_bins(histogram, capacity)
    common = {n: -(-c // RANK_ROWS) for n, c in histogram.items() if c > RANK_ROWS}
    buckets = F.lit(1)
    if common:
        buckets = F.coalesce(F.create_map(*[F.lit(x) for pair in common.items() for x in pair])[F.col(length_col)], F.lit(1))
    flat = [c for c, kind in staged.dtypes if not kind.startswith(("map", "variant"))]
    spread = staged.withColumn(bucket, F.pmod(F.xxhash64(*[F.col(c) for c in flat]), buckets))
    sizes = spread.groupBy(F.col(length_col).alias("__l"), F.col(bucket).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(
        Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    order = [F.col(c) for c in (*order_by, *[c for c in flat if c not in order_by and c != length_col])]
    ranked = (spread.withColumn(rank, F.row_number().over(Window.partitionBy(length_col, bucket).orderBy(*order)) - 1)
              .join(before, (F.col(length_col) == F.col("__l")) & (F.col(bucket) == F.col("__b")))
              .withColumn(rank, F.col(rank) + F.col("__before")).drop("__l", "__b", "__before", bucket))
    return _place(ranked, slots, length_col, rank)


def _place(ranked: DataFrame, slots: Slots, length_col: str, rank: str) -> DataFrame:
    """Look the slot of each (length, rank) up; the slot table is bounded by the
    number of lengths, not by the input."""
    keep = [f for f in ranked.schema.fields if f.name != rank]
    schema = T.StructType([*keep, T.StructField("sequence_id", T.LongType(), False),
                           T.StructField("offset", T.LongType(), False)])
    names = [f.name for f in keep]
    key = (slots.length << 44) + slots.first

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            at = batch.column(rank).to_numpy(zero_copy_only=False).astype(np.int64)
            slot = np.searchsorted(key, (length << 44) + at, side="right") - 1
            inner = at - slots.first[slot]
            bins = slots.bins[slot]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(slots.sequence[slot] + inner % bins),
                 pa.array(slots.offset[slot] + inner // bins * length)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """The filled sequences: ``sequence_id, length, ids`` from packed pieces that
    carry their ids. A sequence holds at most ``capacity`` pieces."""
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        ids = np.concatenate(rows["ids"].to_list())
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "length": [len(ids)], "ids": [ids]})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(
        join, "sequence_id long, length long, ids array<int>")
