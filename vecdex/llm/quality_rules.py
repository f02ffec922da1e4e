"""Quality rules by distribution divergence.

Each document gives two histograms: characters by class, and words over its
language's commonest words (all others in one bin). Each language's reference
is the mean over its distinct texts of the same histograms. A document is
rejected when a Jensen-Shannon distance to its language's reference exceeds
what sampling alone explains at its length: ``base + slope / sqrt(words)``.
Documents below ``MIN_WORDS``, and languages with fewer than ``MIN_TEXTS``
texts of that length, get no verdict from the distances.

Before that stand plain counts: short texts and texts that consist mostly of
repeated word triples fail.

Everything is DataFrame functions. Words are counted exactly per language,
combined before the shuffle, and each task passes on the ``COMMON`` most frequent
words of its share only. Documents are never shuffled: only word counts,
histograms of distinct texts and one row per language are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecdex.llm.common import fresh, words
from vecdex.session import cut_lineage, scratch_path

MIN_WORDS, MIN_TEXTS = 50, 20
COMMON = 24
#: limits of the distances: at any length, and per root of a word
CLASS_LIMIT, WORD_LIMIT = (0.13, 1.0), (0.12, 1.85)
#: languages up to this many are broadcast, about 1 kB each
BROADCAST_LANGUAGES = 4096
CLASSES = ("lower", "upper", "digit", "space", "mark", "sign", "other")
_MARKS, _SIGNS = "[.,;:'\"!?()-]", "[#*$%&|<>]"
#: one letter for each of the commonest words
_LETTERS = "abcdefghijklmnopqrstuvwx"
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUTPUTS = (*_BASE, "base_failed", "class_distance", "word_distance", "kept")


def base_counts(docs: DataFrame, text_col: str = "text", words_as: str | None = None) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` (long), and the words themselves under the name ``words_as``.

    Repeated triples: every window of three words gets a number whose high bits
    hash its words and whose low bits are its place. Sorted, equal windows stand
    side by side; those whose hashes agree are compared by their words, and the
    places that equal ones cover are counted once each."""
    n = {stem: fresh(docs, stem) for stem in ("text", "words", "line", "mask", "codes", "beside", "agree", "spelt", "places")}
    text, own = F.col(n["text"]), F.col(n["words"])
    mask, codes, places = F.col(n["mask"]), F.col(n["codes"]), F.col(n["places"])

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(mask) == 0, F.lit(False))

    three = F.lit(3).cast("long")
    coded = F.transform(own, lambda x, i: F.xxhash64(x, F.get(own, i + 1), F.get(own, i + 2)).bitwiseAND(mask) + i.cast("long"))
    beside = F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: a.bitwiseXOR(b).bitwiseAND(mask) == 0)
    # most texts repeat no triple and are done after one comparison per window
    repeated = F.when(F.array_contains(n["beside"], True), F.filter(
        codes, lambda x, i: same(x, F.get(codes, i - 1)) | same(x, F.get(codes, i + 1)))).otherwise(F.array().cast("array<bigint>"))
    # neighbours whose hashes agree are compared by their words; only if some differ are
    # the windows sorted by their words instead
    agree, spelt = F.col(n["agree"]), F.col(n["spelt"])
    place = lambda x: x.bitwiseAND(F.bitwise_not(mask)).cast("int")
    differ = F.exists(F.zip_with(agree, F.slice(agree, F.lit(2), F.size(agree)), lambda a, b: same(a, b) & (
        F.slice(own, place(a) + 1, F.lit(3)) != F.slice(own, place(b) + 1, F.lit(3)))), lambda x: F.coalesce(x, F.lit(False)))
    windows = F.array_sort(F.transform(agree, lambda x: F.struct(
        F.concat_ws(" ", F.slice(own, place(x) + 1, F.lit(3))).alias("w"), place(x).cast("long").alias("p"))))
    equal = F.filter(spelt, lambda y, i: F.coalesce(y["w"] == F.get(spelt, i - 1)["w"], F.lit(False))
                     | F.coalesce(y["w"] == F.get(spelt, i + 1)["w"], F.lit(False)))
    covered = F.transform(places, lambda x, i: F.least(three, F.coalesce(F.get(places, i + 1) - x, three)))
    return (docs.withColumn(n["text"], F.coalesce(F.col(text_col), F.lit("")))
            .withColumn(n["words"], words(text))
            .withColumn("n_words", F.size(own).cast("long"))
            .withColumn(n["line"], F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
            .withColumn(n["mask"], F.expr("coalesce(-shiftleft(1L, int(ceil(log2(n_words + 2.0D)))), 0L)"))
            .withColumn(n["codes"], F.sort_array(F.slice(coded, 1, F.greatest(F.size(own) - 2, F.lit(0)))))
            .withColumn(n["beside"], beside)
            .withColumn(n["agree"], repeated)
            .withColumn(n["spelt"], F.when((F.size(agree) > 0) & differ, windows))
            .withColumn(n["places"], F.sort_array(F.when(spelt.isNull(), F.transform(
                agree, lambda x: x.bitwiseAND(F.bitwise_not(mask)))).otherwise(F.transform(equal, lambda y: y["p"]))))
            .withColumn("word_chars", F.length(F.array_join(own, "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(text, F.lit(_SIGNS)).cast("long"))
            .withColumn("n_dup_lines", (F.size(n["line"]) - F.size(F.array_distinct(n["line"]))).cast("long"))
            .withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
            .select(*[F.col(c) for c in docs.columns], *_BASE, *([own.alias(words_as)] if words_as else [])))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two distributions, 0 to 1."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    both = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), total(both) / 2))


def common_words(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang__, codes__``: each language's commonest words that hold a letter, as
    a map from the word to its letter of ``_LETTERS`` for every length in bytes from 1
    on: a word is compared with those of its length only."""
    each = docs.select(F.col(lang_col).alias("lang__"), F.explode(words(F.col(text_col))).alias("w"))
    counts = each.groupBy("lang__", "w").agg(F.count(F.lit(1)).alias("n")).where(F.col("w").rlike("\\p{L}"))
    # the limit on the rank is taken in every task before languages meet
    rank = F.row_number().over(Window.partitionBy("lang__").orderBy(F.col("n").desc(), "w"))
    found = counts.withColumn("k", rank).where(F.col("k") <= COMMON)
    top = found.groupBy("lang__").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "w"))).alias("all__"))
    ranked = F.slice("all__", 1, COMMON)
    letters = F.array(*[F.lit(c) for c in _LETTERS])
    spelt = F.zip_with(F.transform("ranked__", lambda x: x["w"]), F.slice(letters, F.lit(1), F.size("ranked__")),
                       lambda w, c: F.struct(w.alias("w"), c.alias("c")))
    longest = F.array_max(F.transform("spelt__", lambda x: F.octet_length(x["w"])))
    return (top.withColumn("ranked__", ranked).where(F.size("ranked__") > 0).withColumn("spelt__", spelt)
            .select("lang__", F.transform(F.sequence(F.lit(1), longest), lambda n: F.map_from_entries(
                F.filter("spelt__", lambda x: F.octet_length(x["w"]) == n))).alias("codes__")))


def _with_language(docs: DataFrame, side: DataFrame, lang_col: str) -> DataFrame:
    """``docs`` with their language's row of ``side``, which is broadcast while
    it is small and else joined by a shuffle."""
    few = side.count() <= BROADCAST_LANGUAGES
    return docs.join(F.broadcast(side) if few else side, F.col(lang_col).eqNullSafe(side["lang__"]), "left")


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with the base counts, ``text_id__``, and both histograms as
    counts: ``words__`` (commonest words, then all others) and ``classes__``.

    A document's common words become a string of one letter each, in which the
    letters are then counted."""
    top = cut_lineage(common_words(docs, text_col, lang_col))
    rows = _with_language(base_counts(docs, text_col, "own__"), top, lang_col)
    text = F.col("text__")
    known = F.transform(F.array(*[F.lit(c) for c in _LETTERS]),
                        lambda c: (F.length("hits__") - F.length(F.replace(F.col("hits__"), c, F.lit("")))).cast("double"))

    def gone(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    return (rows.withColumn("text__", F.coalesce(F.col(text_col), F.lit("")))
            .withColumn("text_id__", F.xxhash64("text__"))
            .withColumn("hits__", F.coalesce(F.array_join(F.transform(
                "own__", lambda w: F.element_at(F.get("codes__", F.octet_length(w) - 1), w)), ""), F.lit("")))
            .withColumn("known__", known)
            .withColumn("words__", F.concat("known__", F.array(F.col("n_words") - total(F.col("known__")))))
            .withColumn("size__", F.length("text__")).withColumn("upper__", gone("\\p{Lu}+"))
            .withColumn("letter__", gone("\\p{L}+")).withColumn("digit__", gone("\\p{N}+"))
            .withColumn("mark__", F.regexp_count("text__", F.lit(_MARKS)))
            .withColumn("classes__", F.expr("""cast(array(letter__ - upper__, upper__, digit__, size__ - word_chars, mark__, n_symbols,
                greatest(0, word_chars - letter__ - digit__ - mark__ - n_symbols)) AS array<double>)"""))
            .drop("lang__", "text__", "own__", "hits__", "known__", "size__", "upper__", "letter__", "digit__", "mark__"))


def references(rows: DataFrame, lang_col: str = "lang") -> DataFrame:
    """``lang__, word_ref__, class_ref__`` from measured rows: a row per language
    with enough texts. Copies count once; a null language is one of its own."""
    texts = (rows.where((F.col("n_words") >= MIN_WORDS) & F.col("codes__").isNotNull())
             .groupBy(F.col(lang_col).alias("lang__"), "text_id__")
             .agg(F.first(F.struct("words__", "classes__", "n_words")).alias("r")))
    size = total(F.col("r.classes__"))
    means = texts.withColumn("size__", size).groupBy("lang__").agg(
        F.count(F.lit(1)).alias("texts"),
        F.array(*[F.round(F.avg(F.col("r.words__")[k] / F.col("r.n_words")), 9) for k in range(COMMON + 1)]).alias("word_ref__"),
        F.array(*[F.round(F.avg(F.col("r.classes__")[k] / F.col("size__")), 9) for k in range(len(CLASSES))]).alias("class_ref__"))
    return cut_lineage(means.where(F.col("texts") >= MIN_TEXTS).drop("texts"))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance,
    kept``.

    Null and empty texts have no words and fail. Distances are null where there
    is no verdict. Repeated rows are judged alike; input columns named like the
    new ones are replaced. An empty table gives an empty result. Texts are read
    twice, for the common words and for the counts; the carried columns and the
    counts are written to the shared folder in between.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in OUTPUTS])
    carry = docs.columns if carry is None else carry
    language = fresh(docs, "language")
    path = scratch_path(docs.sparkSession, "measured")
    (measured(docs, text_col, lang_col).withColumn(language, F.col(lang_col))
     .select(*[F.col(c) for c in carry], language, "codes__", "text_id__", "words__", "classes__", *_BASE).write.parquet(path))
    staged = docs.sparkSession.read.parquet(path)
    rows = _with_language(staged, references(staged, language), language)
    known = (F.col("n_words") >= MIN_WORDS) & F.col("word_ref__").isNotNull()
    root = F.sqrt(F.col("n_words").cast("double"))
    rows = (rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .withColumn("length__", total(F.col("classes__")))
            .withColumn("c__", F.transform("classes__", lambda x: x / F.col("length__")))
            .withColumn("w__", F.transform("words__", lambda x: x / F.col("n_words")))
            .withColumn("class_distance", F.when(known, jensen_shannon(F.col("c__"), F.col("class_ref__"))))
            .withColumn("word_distance", F.when(known, jensen_shannon(F.col("w__"), F.col("word_ref__")))))
    far = reduce(lambda a, b: a | b, [
        F.coalesce(F.col(c) > limit[0] + limit[1] / root, F.lit(False))
        for c, limit in (("class_distance", CLASS_LIMIT), ("word_distance", WORD_LIMIT))])
    return rows.withColumn("kept", ~F.col("base_failed") & ~far).select(*[F.col(c) for c in carry], *OUTPUTS)


def passing(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    names = {c: fresh(docs, f"c{k}_") for k, c in enumerate(docs.columns)}
    text, lang = options.pop("text_col", "text"), options.pop("lang_col", "lang")
    own = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    return (quality_rules(own, text_col=names[text], lang_col=names[lang], **options).where("kept")
            .select(*[F.col(n).alias(c) for c, n in names.items()]))


#: DuckDB SQL for op1's contract columns
SQL = r"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (
  SELECT *, len(w)::BIGINT AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
x AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM x),
p AS (SELECT doc_id, count(DISTINCT place)::BIGINT AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM r WHERE c > 1) GROUP BY doc_id),
base AS (
  SELECT n.*, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(p.n_repeat_words, 0) AS n_repeat_words
  FROM n LEFT JOIN p USING (doc_id)),
lw AS (SELECT doc_id, lang, unnest(w) AS w FROM d),
cw AS (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS k
       FROM lw WHERE regexp_matches(w, '\p{L}') GROUP BY lang, w QUALIFY k <= 24),
wc AS (SELECT lw.doc_id, cw.k, count(*) AS c FROM lw JOIN cw ON lw.w = cw.w AND lw.lang IS NOT DISTINCT FROM cw.lang GROUP BY ALL),
bins AS (SELECT lang, k FROM cw UNION ALL SELECT lang, 25 FROM (SELECT DISTINCT lang FROM cw)),
wk AS (SELECT doc_id, sum(c) AS c FROM wc GROUP BY doc_id),
wp AS (
  SELECT base.doc_id, base.lang, bins.k, CASE WHEN bins.k = 25 THEN n_words - coalesce(wk.c, 0) ELSE coalesce(wc.c, 0) END / n_words::DOUBLE AS p
  FROM base JOIN bins ON base.lang IS NOT DISTINCT FROM bins.lang
  LEFT JOIN wc ON wc.doc_id = base.doc_id AND wc.k = bins.k LEFT JOIN wk ON wk.doc_id = base.doc_id WHERE n_words >= 50),
cc AS (
  SELECT doc_id, lang, t, length(t) AS z, length(t) - length(regexp_replace(t, '\p{L}+', '', 'g')) AS l,
         length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')) AS u, length(t) - length(regexp_replace(t, '\p{N}+', '', 'g')) AS g,
         length(t) - word_chars AS s, length(t) - length(translate(t, '.,;:''"!?()-', '')) AS m, n_symbols AS y FROM base WHERE n_words >= 50),
cp AS (SELECT doc_id, lang, unnest(range(7)) AS k, unnest([l - u, u, g, s, m, y, greatest(0, z - l - g - s - m - y)]) / z::DOUBLE AS p FROM cc),
one AS (SELECT min(doc_id) AS doc_id FROM base WHERE n_words >= 50 GROUP BY lang, t),
langs AS (SELECT lang FROM base SEMI JOIN one USING (doc_id) GROUP BY lang HAVING count(*) >= 20),
wq AS (SELECT lang, k, round(avg(p), 9) AS q FROM wp SEMI JOIN one USING (doc_id) GROUP BY lang, k),
cq AS (SELECT lang, k, round(avg(p), 9) AS q FROM cp SEMI JOIN one USING (doc_id) GROUP BY lang, k),
pq AS (SELECT 'w' AS what, wp.doc_id, wp.lang, p, q FROM wp JOIN wq ON wp.k = wq.k AND wp.lang IS NOT DISTINCT FROM wq.lang
       UNION ALL SELECT 'c', cp.doc_id, cp.lang, p, q FROM cp JOIN cq ON cp.k = cq.k AND cp.lang IS NOT DISTINCT FROM cq.lang),
js AS (
  SELECT what, doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS v
  FROM pq WHERE EXISTS (SELECT 1 FROM langs WHERE langs.lang IS NOT DISTINCT FROM pq.lang) GROUP BY what, doc_id),
far AS (SELECT DISTINCT doc_id FROM js JOIN base USING (doc_id)
        WHERE v > CASE what WHEN 'w' THEN 0.12 + 1.85 / sqrt(n_words::DOUBLE) ELSE 0.13 + 1.0 / sqrt(n_words::DOUBLE) END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM far) AS kept
FROM base
"""
