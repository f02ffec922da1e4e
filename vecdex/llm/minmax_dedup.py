"""Near-duplicate detection by min-max hashing.

Every permutation of the 64-bit shingle hashes yields two signature values, its
minimum and its maximum, so a signature of ``2 * perms`` values costs ``perms``
hash evaluations. Three permutations make a band of six values; documents that
agree on a band are candidates. There are as many bands as it takes for two
documents at the threshold s to miss each other with probability
(1 - s^6)^bands < 3e-7, and less above it: 32 bands for 0.85, 50 for 0.80.

Candidates only propose; a link needs the full shingle sets. Pairs are never
listed group by group:

1. documents with the same set are one class, whatever their number; sets, bucket
   entries and links belong to classes, so an id may stand on several texts;
2. star rounds: in every bucket each class meets the bucket's leader only, one
   pair per member. Confirmed links merge classes into components, and buckets
   that hold a single component are done, a large group of near copies among
   them. Each round takes other leaders;
3. in buckets that still hold several components the remaining links are found
   exactly. Up to ``SMALL`` members, a join meets pairs across components only.
   Larger buckets are cut into hash blocks of bounded size; a task takes two
   blocks, counts common shingles by matrix products and emits no more than a
   spanning forest of the links. Members of the bucket's largest component are
   not met with each other. No link is lost, and no list of pairs is made.

Proposals must first agree on at least ``sketch_agree`` of 192 one-bit sketch
positions, which pairs at the threshold fail with probability below 1e-7.
Components are found by alternating large and small stars. Rounds are tables in
the shared folder, removed once the next one is written.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.llm.common import fresh
from vecdex.session import Scratch

WORDS, PERCENT = 5, 85
BAND_PERMS = 3
#: permutations at least; the first SKETCH_BITS of their values make the sketch
PERMS, SKETCH_BITS = 96, 192
#: a pair at the threshold misses every band, or fails the sketch, with less probability
BAND_MISS, SKETCH_MISS = 3e-7, 1e-7
STAR_ROUNDS = 2
#: members of a bucket whose cross pairs a join may meet; members and shingles of a block beyond that
SMALL, BLOCK_ROWS, BLOCK_SHINGLES = 64, 1024, 1_000_000
#: ids up to this many are broadcast (16 bytes each), larger sets are joined by shuffle
BROADCAST_IDS = 1_000_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_CHUNK = 1 << 15


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bands_for(percent: int) -> int:
    """Bands that pairs of this similarity all miss with probability below ``BAND_MISS``."""
    return max(1, math.ceil(math.log(BAND_MISS) / math.log1p(-min(percent / 100, 0.999) ** (2 * BAND_PERMS))))


def perms_for(percent: int) -> int:
    return max(PERMS, BAND_PERMS * bands_for(percent))


@lru_cache(maxsize=8)
def sketch_agree(percent: int) -> int:
    """Sketch positions that pairs of this similarity agree on, but for a
    probability below ``SKETCH_MISS``: a value that differs still agrees in its
    bit half the time."""
    p, below = (1 + percent / 100) / 2, 0.0
    for k in range(SKETCH_BITS + 1):
        below += math.comb(SKETCH_BITS, k) * p ** k * (1 - p) ** (SKETCH_BITS - k)
        if below >= SKETCH_MISS:
            return k
    return SKETCH_BITS


@lru_cache(maxsize=4)
def _permutations(perms: int = PERMS) -> tuple[np.ndarray, np.ndarray]:
    seed = _mixed(np.arange(1, 2 * perms + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seed[:perms] | np.uint64(1), seed[perms:]


class _Words(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        import xxhash
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000 and len(word) < 100:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _Words:
    return _Words()


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``size``-word shingles; a
    shorter text is one shingle, one without words has none."""
    words = _WORD.findall((text or "").translate(_UPPER) if not (text or "").isascii() else (text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    n = max(1, len(own) - size + 1)
    value = np.full(n, np.uint64(min(len(own), size)))
    for k in range(min(size, len(own))):
        value = _mixed(value ^ own[k:k + n]) + np.uint64(k)
    return np.unique(value)


def signature(hashes: np.ndarray, perms: int = PERMS) -> np.ndarray:
    """Minimum and maximum under each permutation, ``(perms, 2)``."""
    multiply, add = _permutations(perms)
    out = np.empty((perms, 2), np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK]
        for k in range(0, perms, 16):
            values = (part[None, :] ^ add[k:k + 16, None]) * multiply[k:k + 16, None]
            low, high = values.min(axis=1), values.max(axis=1)
            if at:
                low, high = np.minimum(low, out[k:k + 16, 0]), np.maximum(high, out[k:k + 16, 1])
            out[k:k + 16, 0], out[k:k + 16, 1] = low, high
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of ``BAND_PERMS`` permutations, both ends each."""
    rows = sig[:bands * BAND_PERMS].reshape(bands, 2 * BAND_PERMS)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for column in rows.T:
        key = _mixed(key ^ column)
    return key


def set_name(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set of shingles; with its size they name it."""
    if not len(own):
        return 0, 0
    return (int(_mixed(own).sum(dtype=np.uint64).view(np.int64)),
            int(np.bitwise_xor.reduce(_mixed(own * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)))


def _features(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """A row per document: set size, a 128-bit name of the set, band keys and sketch."""
    bands_wanted, perms = bands_for(percent), perms_for(percent)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
                           T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType())),
                           T.StructField("sketch", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, bands, sketch = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text)
                n.append(len(own))
                name = set_name(own)
                a.append(name[0]), b.append(name[1])
                if not len(own):
                    bands.append([]), sketch.append([0, 0, 0])
                    continue
                sig = signature(own, perms)
                bands.append(band_keys(sig, bands_wanted).view(np.int64))
                bits = (_mixed(sig.ravel()[:SKETCH_BITS]) & np.uint64(1)).astype(np.uint8)
                sketch.append(np.packbits(bits).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cls, hashes`` of the wanted classes, from the whole texts of the
    documents that head them. A document id may stand on rows with other sets."""
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("set_a", "set_b", "n")], T.StructField("hashes", T.ArrayType(T.LongType()))])
    heads, names = classes.select(F.col("head").alias("id")).distinct(), classes.select("set_a", "set_b", "n", "cls")
    if classes.count() <= BROADCAST_IDS:
        heads, names = F.broadcast(heads), F.broadcast(names)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col)).join(heads, "id", "left_semi").select(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(0).to_pylist()]
            marks = np.array([(*set_name(s), len(s)) for s in sets], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, marks.T), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], schema.names)

    return own.mapInArrow(run, schema).join(names, ["set_a", "set_b", "n"]).select("cls", "hashes").dropDuplicates(["cls"])


def _agreeing(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches allow the similarity."""
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k])) for k in range(3)])
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * small >= percent * large) & (differ <= SKETCH_BITS - sketch_agree(percent))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("hashes").alias("hb")), "b"))
    common = F.size(F.array_intersect("ha", "hb"))
    return both.where(100 * common >= percent * (F.size("ha") + F.size("hb") - common)).select("a", "b")


def components(links: DataFrame, work: Scratch) -> DataFrame:
    """``a, b``: every node of ``links`` (``a, b``) but the smallest of its
    component, with that smallest one.

    Edges point from the larger node to the smaller. Large stars (larger
    neighbours move to the smallest neighbour) and small stars (smaller
    neighbours and the node itself do) alternate until nothing changes; a chain
    takes about as many rounds as its length has binary digits. Every round is a
    table that goes once the next one is written."""
    edges = work.write(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = work.write(both.join(lowest, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        work.drop(edges)
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        edges = work.write(lowest.select("a", F.col("low").alias("b")).unionByName(
            large.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct())
        work.drop(large)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row. Documents whose
    shingle sets have a similarity of ``percent`` hundredths or more are linked.

    Texts without words, null ones among them, have no shingles and link to
    nothing. Rows that share an id count as one node with several sets: links of
    any of them are links of the node, they share a component, and all of them
    are kept or none. A null id is a node like any other only if it stands alone;
    rows without an id never link and are kept. An empty table gives an empty
    result. Only the two named columns are read. The result is a table in the
    shared folder; every other table made on the way is removed before it returns.
    """
    docs = docs.select(F.col(id_col), F.col(text_col))
    work = Scratch(docs.sparkSession, "near")
    name = ["set_a", "set_b", "n"]
    features = work.write(_features(docs, id_col, text_col, percent))
    named = features.where("id is not null and n > 0")
    # numbers are given once, when the table is written
    classes = work.write(named.groupBy(*name).agg(F.min("id").alias("head"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                         .withColumn("cls", F.monotonically_increasing_id()))
    own = named.select("id", *name).join(classes.select(*name, "cls"), name).select("id", "cls")
    spans = own.groupBy("id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi")
    spans = work.write(spans.select("id", "lo"))
    stars = components(own.join(spans, "id").select(F.col("cls").alias("a"), F.col("lo").alias("b")), work)
    entries = classes.select("cls", "n", "sketch", F.explode("bands").alias("bucket"))
    # grouped sides are written before they are joined, so that both sides of
    # the join are shuffled and a bucket that holds a third of the rows can be split
    shared = work.write(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("__m")).where("__m > 1").select("bucket"))
    left = work.write(entries.join(shared, "bucket"))
    wanted = work.write(left.select("cls").distinct())
    sets = work.write(_sets(docs, classes.join(wanted, "cls"), id_col, text_col))
    work.drop(shared, wanted)
    for k in range(STAR_ROUNDS + 1):
        opened = _unresolved(left, stars, work)
        work.drop(left)
        left = opened
        if opened.isEmpty():
            break
        if k < STAR_ROUNDS:
            leader, pairs = _star_pairs(opened, k, percent, work)
        else:
            leader, pairs = None, _cross_pairs(opened.where(F.col("members") <= SMALL), percent)
        links = confirmed(pairs, sets, percent)
        if k == STAR_ROUNDS:
            links = links.unionByName(_block_links(opened.where(F.col("members") > SMALL), sets, percent))
        new = work.write(links)
        merged = components(stars.unionByName(new), work)
        work.drop(stars, new, *([leader] if leader else []))
        stars = merged
    label = classes.select(*name, "cls", "head").join(stars, F.col("cls") == F.col("a"), "left").select(
        *name, "head", F.coalesce("b", "cls").alias("root"))
    first = label.groupBy("root").agg(F.min("head").alias("component"))
    label = work.write(label.select(*name, "root").join(first, "root").select(*name, "component"))
    found = features.select("id", *name).join(label, name, "left")
    out = work.write(found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component", "id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
    work.close(keep=out)
    return out


def _unresolved(entries: DataFrame, stars: DataFrame, work: Scratch) -> DataFrame:
    """Entries, with their component, of the buckets that hold several."""
    marked = (entries.select("bucket", "cls", "n", "sketch").join(stars.withColumnRenamed("a", "cls"), "cls", "left")
              .select("bucket", "cls", "n", "sketch", F.coalesce("b", "cls").alias("component")))
    several = work.write(marked.groupBy("bucket").agg(
        F.min("component").alias("__lo"), F.max("component").alias("__hi"), F.count(F.lit(1)).alias("members"))
        .where("__lo <> __hi").select("bucket", "members"))
    out = work.write(marked.join(several, "bucket"))
    work.drop(several)
    return out


def _star_pairs(entries: DataFrame, k: int, percent: int, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """The leaders of round ``k``, and each member with its bucket's leader, across components."""
    by = F.xxhash64("cls", F.lit(k)) if k else F.col("cls")
    leader = entries.groupBy("bucket").agg(F.min_by(F.struct("cls", "n", "sketch", "component"), by).alias("l"))
    leader = work.write(leader.select("bucket", "l.*"))
    return leader, (entries.alias("x").join(leader.alias("y"), "bucket")
                    .where((F.col("x.component") != F.col("y.component")) & _agreeing("x", "y", percent))
                    .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct())


def _cross_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs across components of a bucket that could be similar enough; the
    join's condition keeps members of one component apart."""
    return (entries.alias("x").join(entries.alias("y"), (F.col("x.bucket") == F.col("y.bucket"))
                                    & (F.col("x.cls") < F.col("y.cls"))
                                    & (F.col("x.component") != F.col("y.component")) & _agreeing("x", "y", percent))
            .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())


def _blocks(rows: str, size: str) -> Column:
    return F.ceil(F.greatest(F.col(rows) / BLOCK_ROWS, F.col(size) / BLOCK_SHINGLES)).cast("int")


def _block_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across the components of large buckets, from pairs of blocks. The
    core (a bucket's largest component) meets the rest only."""
    parts = entries.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size"))
    core = parts.groupBy("bucket").agg(
        F.max(F.struct("rows", "component", "size")).alias("core"), F.sum("rows").alias("all_rows"), F.sum("size").alias("all_size"))
    plan = (core.withColumn("core_rows", F.col("core.rows")).withColumn("core_size", F.col("core.size"))
            .withColumn("rest_rows", F.col("all_rows") - F.col("core_rows")).withColumn("rest_size", F.col("all_size") - F.col("core_size"))
            .select("bucket", F.col("core.component").alias("core"), _blocks("core_rows", "core_size").alias("cores"),
                    _blocks("rest_rows", "rest_size").alias("rests")))
    rows = entries.select("bucket", "cls", "component").join(plan, "bucket").withColumn("in_core", F.col("component") == F.col("core"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), F.when(F.col("in_core"), F.col("cores")).otherwise(F.col("rests"))).cast("int"))
    meets = F.when(F.col("in_core"), F.expr("transform(sequence(0, rests - 1), i -> struct(i AS x, block AS y, true AS c))")).otherwise(
        F.expr("""concat(transform(sequence(0, rests - 1), i -> struct(least(i, block) AS x, greatest(i, block) AS y, false AS c)),
                         transform(sequence(0, cores - 1), i -> struct(block AS x, i AS y, true AS c)))"""))
    rows = rows.select("bucket", "cls", "component", "in_core", "block", F.explode(meets).alias("meet"))
    return (rows.select("bucket", "cls", "component", "in_core", "block", "meet.x", "meet.y", "meet.c").join(sets, "cls")
            .groupBy("bucket", "x", "y", "c").applyInPandas(lambda pair: _linked(pair, percent), "a long, b long"))


def _linked(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links between two blocks."""
    if rows["c"].iloc[0]:
        left, right = rows[~rows["in_core"]], rows[rows["in_core"]]
    else:
        left, right = rows[rows["block"] == rows["x"]], rows[rows["block"] == rows["y"]]
    common = common_shingles(left["hashes"].to_list(), right["hashes"].to_list())
    sizes = [side["hashes"].map(len).to_numpy() for side in (left, right)]
    union = sizes[0][:, None] + sizes[1][None, :] - common
    linked = (100 * common >= percent * union) & (left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :])
    edges = spanning_edges(linked)
    return pd.DataFrame({"a": left["cls"].to_numpy()[edges[:, 0]], "b": right["cls"].to_numpy()[edges[:, 1]]})


def common_shingles(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1
    matrices over a bounded number of shingles at a time."""
    flat = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in (left, right)]
    owner = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    out = np.zeros((len(left), len(right)), np.int64)
    column = []
    for k in range(2):
        keep = np.isin(flat[k], shared)
        owner[k] = owner[k][keep]
        column.append(np.searchsorted(shared, flat[k][keep]))
    for at in range(0, len(shared), width):
        matrix = []
        for k, side in enumerate((left, right)):
            here = (column[k] >= at) & (column[k] < at + width)
            m = np.zeros((len(side), min(width, len(shared) - at)), np.float32)
            m[owner[k][here], column[k][here] - at] = 1
            matrix.append(m)
        out += (matrix[0] @ matrix[1].T).astype(np.int64)
    return out


def spanning_edges(linked: np.ndarray) -> np.ndarray:
    """Edges that connect what the two-sided link matrix connects, fewer than rows and columns together."""
    free_rows, free_columns, edges = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool), []
    for start in np.flatnonzero(linked.any(axis=1)):
        if not free_rows[start]:
            continue
        free_rows[start] = False
        todo = [(True, start)]
        while todo:
            is_row, k = todo.pop()
            line, free = (linked[k], free_columns) if is_row else (linked[:, k], free_rows)
            found = np.flatnonzero(line & free)
            free[found] = False
            edges += [(k, f) if is_row else (f, k) for f in found]
            todo += [(not is_row, f) for f in found]
    return np.array(edges, np.int64).reshape(-1, 2)


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with its
    smallest id, and every row without an id. Ids should be unique by now; rows
    that share a kept id all stay. What goes is the smaller side of the join."""
    marked = near_duplicates(docs, id_col, text_col, percent)
    gone = marked.where("not kept").select(F.col(id_col).alias(fresh(docs, "gone"))).distinct()
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(side, docs[id_col] == side[side.columns[0]], "left_anti")
