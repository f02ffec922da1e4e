"""J5 with approximate titles: a set-similarity join instead of one remote fuzzy
search per point.

Two strings within ``max_edits`` insertions, deletions and replacements of code
points are found without comparing all pairs:

* Each string is cut into overlapping q-grams with their places (padded at both
  ends). An edit destroys at most q of them, so of the ``q * max_edits + 1`` grams
  that are rarest over the catalogue at least one of either string's survives in
  the other, at most ``max_edits`` places off. Strings meet only through these
  prefix grams (ties of the last gram included).
* A string too short to have so many grams meets others through the strings left
  after deleting up to ``max_edits`` code points, which two such strings share.

Places, lengths and the edit distance itself are conditions of the join, so pairs
that fail are never rows. Before the distance stands a cheap bound: a long holds in
each bit whether the code points of that bit occur an odd number of times, and an edit
turns two bits at most. A gram that many strings share is dealt into blocks on
both sides: a task holds one block of each, and every pair of blocks meets once.
Strings are made distinct first, so a title that a third of the rows bear counts
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecdex.functions.text import js_trim
from vecdex.session import Scratch, within_bytes

Q = 3
#: strings of one gram on one side that one task takes at once
BLOCK = 4000


def normalised(title: Column) -> Column:
    """How titles are compared: trimmed and in lower case."""
    return F.lower(js_trim(title))


def _grams(strings: DataFrame, q: int) -> DataFrame:
    """``s, gram, place`` of strings ``s``, padded so that the ends count too."""
    padded = F.concat(F.lit("\x01" * (q - 1)), "s", F.lit("\x02" * (q - 1)))
    at = F.sequence(F.lit(1), F.length("s") + q - 1)
    return strings.select("s", F.posexplode(F.transform(at, lambda k: F.substring(padded, k, F.lit(q)))).alias("place", "gram"))


def parity(s: Column) -> Column:
    """A long whose bits tell which code points, by their hash, occur an odd number of
    times. An insertion or deletion turns one bit, a replacement two at most."""
    bits = F.transform(F.sequence(F.lit(0), F.length(s)), lambda k: F.when(
        k > 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(F.substring(s, k, F.lit(1))), F.lit(64)))).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _prefixes(strings: DataFrame, often: DataFrame, q: int, max_edits: int) -> DataFrame:
    """``s, odd, gram, place``: the rarest grams of each string, ties of the last
    included, and its parity."""
    need = q * max_edits
    known = often if not within_bytes(often) else F.broadcast(often)
    marked = _grams(strings, q).join(known, "gram", "left").select("s", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "place").alias("g"))
    own = marked.groupBy("s").agg(F.array_sort(F.collect_list("g")).alias("gs"))  # as long as the string
    last = F.element_at("gs", F.least(F.size("gs"), F.lit(need + 1)))
    first = F.filter("gs", lambda g: (g["n"] < last["n"]) | ((g["n"] == last["n"]) & (g["gram"] <= last["gram"])))
    return own.withColumn("odd", parity(F.col("s"))).select("s", "odd", F.explode(first).alias("g")).select("s", "odd", "g.gram", "g.place")


def _dealt(left: DataFrame, right: DataFrame, block: int, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """Both sides with blocks ``a`` (of the left) and ``b`` (of the right) of their
    gram; a side's own block is a hash of its string, the other's are all."""
    counts = (left.select("gram", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("gram", F.lit(0).alias("l"), F.lit(1).alias("r")))
              .groupBy("gram").agg(F.sum("l").alias("l"), F.sum("r").alias("r")).where((F.col("l") > block) | (F.col("r") > block)))
    crowded = work.write(counts.select("gram", F.ceil(F.greatest("l", F.lit(1)) / block).cast("int").alias("as"),
                                       F.ceil(F.greatest("r", F.lit(1)) / block).cast("int").alias("bs")))
    many = F.broadcast(crowded) if within_bytes(crowded) else crowded
    out = []
    for side, own, all_ in ((left, "as", "bs"), (right, "bs", "as")):
        dealt = side.join(many, "gram", "left")
        mine = F.pmod(F.xxhash64("s"), F.coalesce(own, F.lit(1))).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.coalesce(all_, F.lit(1)) - 1))
        names = ("a", "b") if own == "as" else ("b", "a")
        out.append(dealt.select("s", "odd", "gram", "place", mine.alias(names[0]), others.alias(names[1])))
    return out[0], out[1]


def _shortened(strings: DataFrame, max_edits: int) -> DataFrame:
    """``s, key``: what is left of a string after up to ``max_edits`` deletions."""
    keys = F.array("s")
    for _ in range(max_edits):
        one = F.transform(F.filter(keys, lambda w: F.length(w) > 0), lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w)), lambda k: F.concat(F.substring(w, F.lit(1), k - 1), F.substring(w, k + 1, F.length(w)))))
        keys = F.array_distinct(F.concat(keys, F.flatten(one)))
    return strings.select("s", F.explode(keys).alias("key"))


def similar_strings(left: DataFrame, right: DataFrame, max_edits: int = 2, *, q: int = Q, block: int = BLOCK) -> DataFrame:
    """``l, r, edits``: every pair of a string of ``left`` and one of ``right`` (one
    column each, any name) that are at most ``max_edits`` apart, once. Nulls match
    nothing; the empty string is a string like any other."""
    work = Scratch(left.sparkSession, "similar")
    ls, rs = (work.write(side.select(F.col(side.columns[0]).alias("s")).where("s is not null").distinct()) for side in (left, right))
    short = max(q * max_edits - q + 1, 0)  # so short that a string has no more than q * max_edits grams
    often = work.write(_grams(rs, q).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    prefixes = [work.write(_prefixes(side.where(F.length("s") > short), often, q, max_edits)) for side in (ls, rs)]
    a, b = _dealt(*prefixes, block, work)
    edits = F.levenshtein(F.col("x.s"), F.col("y.s"), max_edits)
    near = (F.abs(F.length("x.s") - F.length("y.s")) <= max_edits) & (edits >= 0)
    alike = F.bit_count(F.col("x.odd").bitwiseXOR(F.col("y.odd"))) <= 2 * max_edits
    long_pairs = a.alias("x").join(b.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.a") == F.col("y.a"))
                                   & (F.col("x.b") == F.col("y.b")) & (F.abs(F.col("x.place") - F.col("y.place")) <= max_edits) & alike & near)
    small = [_shortened(side.where(F.length("s") <= short + max_edits), max_edits) for side in (ls, rs)]
    short_pairs = small[0].alias("x").join(small[1].alias("y"), (F.col("x.key") == F.col("y.key")) & near
                                           & (F.least(F.length("x.s"), F.length("y.s")) <= short))
    pairs = long_pairs.select(F.col("x.s").alias("l"), F.col("y.s").alias("r")).unionByName(
        short_pairs.select(F.col("x.s").alias("l"), F.col("y.s").alias("r"))).distinct()
    out = work.write(pairs.select("l", "r", F.levenshtein("l", "r").alias("edits")))
    work.close(keep=out)
    return out


def fuzzy_lookup(points: DataFrame, catalogue: DataFrame, *, max_edits: int = 2, title_col: str = "title",
                 year_col: str = "release_year", key: str = "id", **options) -> DataFrame:
    """``key, match_title, edits, poster_path`` for every point: of the catalogue rows
    whose title is at most ``max_edits`` away (and of the point's year, where it has
    one) the nearest, then the best rank, then the first title. The match counts
    even if its poster is null; an empty poster path counts as null (F8). Points
    without a match, or without a title, have nulls. Rows of one title and year
    must differ in rank."""
    work = Scratch(points.sparkSession, "fuzzy")
    rows = catalogue.select(normalised(F.col("title")).alias("r"), "year", "rank", "poster_path")
    # one row per title and year, and per title; combined before the shuffle
    top = F.min_by(F.struct("rank", "poster_path"), "rank").alias("best")
    by_year = work.write(rows.groupBy("r", "year").agg(top))
    by_title = by_year.groupBy("r").agg(F.min_by("best", "best.rank").alias("best"))
    asked = points.select(F.col(key).alias("__key"), normalised(F.col(title_col)).alias("l"), F.col(year_col).alias("y"))
    wanted = work.write(asked.select("l", "y").where("l is not null").distinct())
    pairs = work.write(similar_strings(wanted.select("l"), by_year.select("r"), max_edits, **options))
    dated = (wanted.where("y is not null").join(pairs, "l").join(by_year.withColumnRenamed("year", "y"), ["r", "y"]).select("l", "y", "r", "edits", "best"))
    undated = wanted.where("y is null").join(pairs, "l").join(by_title, "r").select("l", "y", "r", "edits", "best")
    found = work.write(dated.unionByName(undated).groupBy("l", "y").agg(
        F.min_by(F.struct("r", "edits", "best"), F.struct("edits", "best.rank", "r")).alias("m")))
    same = (F.col("p.l") == F.col("f.l")) & F.col("p.y").eqNullSafe(F.col("f.y"))
    out = work.write(asked.alias("p").join(found.alias("f"), same, "left").select(
        F.col("__key").alias(key), F.col("m.r").alias("match_title"), F.col("m.edits").alias("edits"),
        F.nullif(F.col("m.best.poster_path"), F.lit("")).alias("poster_path")))
    work.close(keep=out)
    return out
