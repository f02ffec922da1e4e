"""Spelling variant grouping by dynamic programming over sorted word lists.

Words are counted over all texts. Two words are near if one insertion, deletion
or replacement of a code point turns one into the other. If the shorter of them
has l code points, the two share their first ``ceil((l - 1) / 2)`` code points or
their last ``l - ceil((l - 1) / 2)``: what stands before and after the edit is at least
``l - 1`` code points long. So every word enters a list for each length l
it can be near at, once by its head and once, written backwards, by its tail.

A list is sorted and scanned once per member. The scan keeps the rows of a banded
edit matrix for the prefix of the current word, takes over the rows of the
longest common prefix with the word before, and once every cell of a row is above
one edit it jumps over all words that share that prefix. A pair whose heads agree
is left to the head's list, so each near pair counts once for each of its words.

Lists of more than ``LIST_WORDS`` words are dealt into blocks, and pairs of blocks
meet: a task never holds more than two blocks, and no pair is lost. A scan gives
one row per word that has near words (how many, and the most frequent), never a
list of pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecdex.session import Scratch

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: words of one sorted list; longer lists are dealt into blocks
LIST_WORDS = 20_000
#: words of the vocabulary to one scanning task, which sees each about four times
PART_WORDS = 10_000
#: distinct words a counting task holds before it passes its counts on
HELD_WORDS = 500_000
#: long lists up to this many are broadcast, about 50 bytes each
BROADCAST_LISTS = 100_000
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: runs of letters of all texts, lower-cased (A-Z only), with one
    code point deleted where the checksum of ``<id>:<run>`` is a multiple of
    ``every``. A null id is written as nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                lead = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in Counter(_RUN.findall(text.translate(_UPPER) if not text.isascii() else text.lower())).items():
                    if len(word) < min_length:
                        continue
                    h = zlib.crc32(word.encode(), lead)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    parts = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def _entries(words: DataFrame) -> DataFrame:
    """``word, n, l, back, key, x``: each word in the lists it can have near words
    in; ``x`` is the word as the list spells it."""
    size = F.length("word")
    lists = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("l"))
    lists = lists.where("l > 0").select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    x = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    head = F.ceil((F.col("l") - 1) / 2)
    shared = F.when(F.col("back"), F.col("l") - head).otherwise(head).cast("int")
    return lists.select("word", "n", "l", "back", F.substring(x, F.lit(1), shared).alias("key"), x.alias("x"))


def near_words(words: DataFrame, work: Scratch, list_words: int = LIST_WORDS) -> DataFrame:
    """``word, n_near, form_n, near``: for every word with near words their number
    and the one of largest count, ties by code point."""
    entries = _entries(words)
    by = ["back", "l", "key"]
    sizes = work.write(entries.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > list_words)
                       .select(*by, F.ceil(F.col("size") / list_words).cast("int").alias("blocks")))
    long = F.broadcast(sizes) if sizes.count() <= BROADCAST_LISTS else sizes
    dealt = entries.join(long, by, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "own").alias("i"), F.greatest(k, "own").alias("j")))
    dealt = dealt.withColumn("meet", F.explode(meet)).select(*by, "meet.i", "meet.j", "own", "x", "word", "n")
    group = [*by, "i", "j"]
    # a count of partitions that follows the work: few bytes make many scans
    parts = max(dealt.sparkSession.sparkContext.defaultParallelism, -(-words.count() // PART_WORDS))
    found = dealt.repartition(parts, *group).sortWithinPartitions(*group, "x").select(*group, "own", "x", "n").mapInArrow(
        _scan, "word string, n_near long, form_n long, near string")
    return _best(found)


def _best(found: DataFrame) -> DataFrame:
    """The parts of a word's answer from several lists as one. Strings of Spark
    compare by their bytes, which is code point order."""
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.max("form_n").alias("form_n"),
                                     F.min_by("near", F.struct(-F.col("form_n"), F.col("near"))).alias("near"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams over groups that lie one after the other, sorted; one is held at a time."""
    out: list[tuple] = []
    held: list[tuple] = []
    name = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:5] != name:
                if len(held) > 1:
                    out += _near_in_list(name, held)
                name, held = row[:5], []
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            held.append(row[5:])
    if len(held) > 1:
        out += _near_in_list(name, held)
    yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
        columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "form_n", "near"])


def _near_in_list(name: tuple, held: list[tuple]) -> list[tuple]:
    """Answers of one group: of block i's words against block j's and the other way."""
    back, length, key, i, j = name
    skip = len(key)
    if i == j:
        meets = [(held, held)]
    else:
        left, right = ([h for h in held if h[0] == k] for k in (i, j))
        meets = [(left, right), (right, left)]
    out = []
    for queries, others in meets:
        if not queries or not others:
            continue
        words = [x for _, x, _ in others]
        counts = [n for _, _, n in others]
        shared = [0, *map(common_prefix, words, words[1:])]
        jump = jumps(shared)
        head = -(-(length - 1) // 2)
        for _, q, _ in queries:
            total, best = 0, None
            for k in near_positions(q, words, shared, jump, skip):
                w = words[k]
                if min(len(q), len(w)) != length or (back and q[::-1][:head] == w[::-1][:head]):
                    continue  # counted in another list
                total += 1
                spelt = w[::-1] if back else w
                if best is None or (-counts[k], spelt) < best:
                    best = (-counts[k], spelt)
            if total:
                out.append((q[::-1] if back else q, total, -best[0], best[1]))
    return out


def common_prefix(a: str, b: str) -> int:
    for k, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return k
    return min(len(a), len(b))


def jumps(shared: list[int]) -> list[int]:
    """For each word the next one that shares less with the word before it."""
    out, waiting = [len(shared)] * len(shared), []
    for k, size in enumerate(shared):
        while waiting and shared[waiting[-1]] > size:
            out[waiting.pop()] = k
        waiting.append(k)
    return out


def near_positions(q: str, words: list[str], shared: list[int], jump: list[int], start: int = 0) -> list[int]:
    """Positions in a sorted list of the words exactly one edit from ``q``. All of
    them share the first ``start`` code points with ``q``; ``shared`` holds each
    word's common prefix with the word before, ``jump`` what ``jumps`` makes of it.

    ``rows[d]`` holds the edits between the first ``d`` code points of the word and
    the first ``d - 1``, ``d`` and ``d + 1`` of ``q``; 2 stands for more than one."""
    found = []
    size, n = len(q), len(words)
    rows = [(2, 2, 2)] * (size + 3)
    rows[start] = (1 if start else 2, 0, 1 if start < size else 2)
    at, depth = 0, start
    while at < n:
        word = words[at]
        end = min(len(word), size + 2)
        a, b, c = rows[depth]
        while depth < end and not (a > 1 and b > 1 and c > 1):
            letter = word[depth]
            x = min(2, b + 1, a + (letter != q[depth - 1]) if 0 < depth <= size else 2)
            y = min(2, c + 1, x + 1, b + (letter != q[depth])) if depth < size else 2
            z = min(2, y + 1, c + (letter != q[depth + 1])) if depth + 1 < size else 2
            a, b, c = x if depth <= size else 2, y, z
            depth += 1
            rows[depth] = (a, b, c)
        settled = a > 1 and b > 1 and c > 1
        if not settled and depth == len(word) and abs(size - depth) <= 1 and (a, b, c)[size - depth + 1] == 1:
            found.append(at)
        at += 1
        if settled:  # so is every word that shares this prefix
            while at < n and shared[at] >= depth:
                at = jump[at]
        if at < n:
            depth = min(depth, shared[at])
    return found


def roots(forms: DataFrame, work: Scratch) -> DataFrame:
    """``word, root``: from each word with a form along forms to the last. Every
    form is more frequent than its word, so there are no cycles, and steps double."""
    now = work.write(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = work.write(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        work.drop(now)
        moved = not step.where("moved").isEmpty()
        now = work.write(step.select("word", "root")) if moved else step.select("word", "root")
        if not moved:
            return now
        work.drop(step)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word of the vocabulary once.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code point
    order) if that is at least ``ratio`` times the word's, else null; ``root`` is
    the end of the chain of forms, the word itself without one. Null and empty
    texts have no words, repeated rows count again, and an empty table gives an
    empty result. Only the two named columns are read. ``options`` go to
    ``word_counts``."""
    work = Scratch(docs.sparkSession, "spelling")
    words = work.write(word_counts(docs, id_col, text_col, **options))
    near = near_words(words, work)
    fits = F.col("form_n") >= ratio * F.col("n")
    joined = work.write(words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("form_n")).alias("form_n")))
    last = roots(joined.where("form is not null").select("word", "form"), work)
    out = work.write(joined.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    work.close(keep=out)
    return out
