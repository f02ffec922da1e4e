"""Native operators: quality rules, exact dedup, sharding, mixing."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

from vecdex.llm import exact_dedup, mixing, quality_rules, sharding
from vecdex.llm.registry import QUERIES, SQL
from vecdex.sources.tables import table

SF = "/root/testdata/sf0.001"
EDGE = "doc_id long, text string, lang string, source string, n_chars long, kept string, target int, `__text` string, size string"


def edge(spark, extra=()):
    row = lambda i, t, lang="en", s="a": (i, t, lang, s, 1, "k", 7, "q", "z")
    return spark.createDataFrame([row(1, None), row(1, None), row(None, ""), row(2, "one two"), row(3, "One two", None, None),
                                  row(4, "word " * 50_000), row(5, "a b c " * 40, "xx", "b"), *[row(*x) for x in extra]], EDGE)


@pytest.mark.parametrize("key", ["op1_quality_rules", "op6_exact_dedup", "op10_mix"])
def test_matches_sql(spark, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(SQL[key]).df().sort_values("doc_id").reset_index(drop=True)
    got = QUERIES[key](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert (got[want.columns].round(6) == want.round(6)).all().all()


@pytest.mark.parametrize("key", ["op1_quality_rules", "op6_exact_dedup", "op8_hilbert_shards", "op10_mix"])
def test_native_plans(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))


def repeats(words):
    seen, places = {}, set()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    for i, w in enumerate(windows):
        if seen[w] > 1:
            places.update((i, i + 1, i + 2))
    return len(places)


def test_base_counts_by_brute_force(spark):
    texts = [None, "", " \t ", "a", "a a a a", "a b c a b c", "x y z q x y z", "l1\nl1\n\nl2\n \nl2", "#a $b\x0bc|", "é b 😀 c",
             "a b a b a b", " lead trail ", "\n\n"]
    rows = quality_rules.base_counts(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()
    for r in rows:
        t = r.text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", t) if w]
        lines = [x for x in t.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == repeats(words), repr(t)


def test_equal_hashes_are_compared_by_words(spark, monkeypatch):
    """Under a hash with eight values most windows clash; the counts stay exact."""
    import random
    r = random.Random(6)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 60))) for _ in range(60)]
    real = F.xxhash64
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: F.shiftleft(F.pmod(real(*c), F.lit(8)), 40))
    rows = quality_rules.base_counts(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()
    assert [x.n_repeat_words for x in sorted(rows, key=lambda x: x.i)] == [repeats(t.split()) for t in texts]


def test_common_words_are_ranked_by_exact_counts(spark):
    """Many words whose counts differ by one, spread over partitions."""
    rows = [(k, f"w{k % 40:02d}x " * (1 + (k % 40) // 2) + "1 2 3", "en" if k % 5 else None) for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(16)
    got = {x.lang__: x.codes__ for x in quality_rules.common_words(df, "text", "lang").collect()}
    for lang in ("en", None):
        count = {}
        for _, t, g in rows:
            if g == lang:
                for w in t.split():
                    count[w] = count.get(w, 0) + 1
        best = sorted((w for w in count if w[0] == "w"), key=lambda w: (-count[w], w))[:24]
        assert got[lang] == dict(zip(best, quality_rules._LETTERS))


def test_quality_edges(spark):
    got = {r.doc_id: r for r in quality_rules.quality_rules(edge(spark)).collect()}
    assert not any(r.kept for r in got.values())  # short, or made of repeats
    assert all(r.base_failed for r in got.values()) and got[4].n_repeat_words == 50_000
    assert got[5]["__text"] == "q" and got[1].word_distance is None
    assert quality_rules.quality_rules(edge(spark).limit(0)).count() == 0


def test_quality_keeps_clean_and_rejects_junk(spark):
    rows = (QUERIES["op1_quality_rules"](spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
            .where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect())
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] >= 0.99 and kept[0] <= 0.1


def test_jensen_shannon(spark):
    import math
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.25, 0.75], [0.5, 0.5])], "p array<double>, q array<double>")
    got = [r[0] for r in df.select(quality_rules.jensen_shannon(F.col("p"), F.col("q"))).collect()]

    def kl(p, q):
        return sum(a * math.log2(a / b) for a, b in zip(p, q, strict=True) if a)
    m = [0.375, 0.625]
    assert got == pytest.approx([1, 0, math.sqrt((kl([0.25, 0.75], m) + kl([0.5, 0.5], m)) / 2)])


def test_dedup_edges(spark):
    rows = exact_dedup.dedup(edge(spark, [(9, "ONE TWO")])).collect()
    by = {}
    for r in rows:
        by.setdefault((r.text or "").lower(), []).append(r)
    assert len(rows) == 8
    for group in by.values():
        assert {r.group_size for r in group} == {len(group)} and sum(r.kept for r in group) == 1
        assert {r.keep_id for r in group} == {max((r.doc_id for r in group if r.doc_id is not None))}
    assert rows[0]["kept"] in (True, False) and rows[0]["__text"] == "q"
    assert exact_dedup.deduplicated(edge(spark)).columns == edge(spark).columns
    assert exact_dedup.deduplicated(edge(spark).limit(0)).count() == 0


def test_dedup_compares_full_bytes(spark):
    """Under a digest that always clashes, the texts themselves decide."""
    df = edge(spark, [(9, "ONE TWO")])
    one = sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in exact_dedup.dedup(df).collect())
    two = sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in exact_dedup.dedup(df, digest=lambda t: F.encode(F.lit("x"), "UTF-8")).collect())
    assert one == two


def test_dedup_state_outlives_runs(spark, tmp_path):
    """A later run goes on from the stored state; batches arrive one file at a time."""
    src, ck, out = (str(tmp_path / x) for x in ("src", "ck", "out"))

    def arrive(rows):
        df = spark.createDataFrame(rows, "digest string, id long, locator string")
        df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
        exact_dedup.track(stream, ck, out)
        return {r.digest: (r.keep.id, r.keep.locator, r.group_size) for r in exact_dedup.entries(spark, out).collect()}

    assert arrive([("a", 1, "p"), ("b", 2, "q")]) == {"a": (1, "p", 1), "b": (2, "q", 1)}
    assert arrive([("a", 5, "r"), ("c", None, "s")]) == {"a": (5, "r", 2), "b": (2, "q", 1), "c": (None, "s", 1)}
    assert arrive([("a", 3, "t")])["a"] == (5, "r", 3)


@pytest.mark.parametrize(("n", "bits"), [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_hilbert_visits_neighbours(spark, n, bits):
    cells = [F.shiftright(F.col("id"), bits * i).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") for i in range(n)]
    rows = spark.range(1 << (n * bits)).select(*[c.alias(f"c{i}") for i, c in enumerate(cells)],
                                               sharding.hilbert_index(cells, bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << (n * bits)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a[:n], b[:n], strict=True)) == 1


def test_op8_contract(spark):
    import zlib
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op8_hilbert_shards"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = {}
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_shard_edges(spark, tmp_path):
    rows = sharding.hilbert_shards(edge(spark), ["lang", "source", "n_chars", "kept"]).collect()
    assert len(rows) == 7 and sorted(r.shard for r in rows) == sorted({r.shard for r in rows})
    assert {r["size"] for r in rows if r.doc_id in (1, None)} == {1}
    assert sharding.hilbert_shards(edge(spark).limit(0), ["lang"]).count() == 0
    sharding.write_shards(edge(spark), str(tmp_path / "s"), ["lang", "source"], files=3)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 7


def test_cuts_are_exact_quantiles_of_whole_values(spark):
    """Strings with long common prefixes, numbers with ties and odd values, against sorted lists."""
    import math
    import random
    r = random.Random(4)
    rows = [(r.choice(["common_crawl_a", "common_crawl_b", "common_crawl_c", "https://x.example/1", "https://x.example/2", None]),
             r.choice([1.0, 2.0, float("nan"), None, float("inf"), r.random()]), r.randint(0, 40)) for _ in range(800)]
    df = spark.createDataFrame(rows, "s string, f double, n int").repartition(5)
    for bits in (1, 3, 5):
        cuts = sharding.cut_points(df, ["s", "f", "n"], bits)
        for k, name in enumerate(("s", "f", "n")):
            values = sorted(x[k] for x in rows if x[k] is not None and x[k] == x[k])
            at = {values[math.ceil(len(values) * j / (1 << bits)) - 1] for j in range(1, 1 << bits)}
            assert cuts[name] == sorted(at - {values[-1]} | ({values[-1]} & set(cuts[name]))), (bits, name)
    cells = df.select("s", sharding.cell(F.col("s"), sharding.cut_points(df, ["s"])["s"]).alias("c")).distinct().collect()
    by = {x.s: x.c for x in cells}
    assert len({by[s] for s in by if s}) == 5 and by[None] == 0
    order = sorted(s for s in by if s)
    assert [by[s] for s in order] == sorted(by[s] for s in order)


def test_shards_prune_by_sources_with_one_prefix(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                    F.concat(F.lit("common_crawl_"), F.col("id") % 16).alias("source"), (F.hash("id") % 100).alias("n"))
    sharding.write_shards(rows, str(tmp_path / "p"), ["source", "n"], files=16)
    held = spark.read.parquet(str(tmp_path / "p")).groupBy(F.input_file_name()).agg(F.countDistinct("source").alias("k")).collect()
    assert sum(r.k for r in held) / len(held) < 8  # of 16 sources a file holds a part
    cells = sharding.hilbert_shards(rows, ["source", "n"])
    again = sharding.hilbert_shards(rows.repartition(7), ["source", "n"])
    key = lambda df: sorted((r.doc_id, r.hilbert, r.shard, r.slot) for r in df.collect())
    assert key(cells) == key(again)


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 50), ("d", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights a 5, b 2, c 1, d 5, null 2; 390 words: a and d are capped, the rest shares 370 by 2:1:2, null is capped at 100
    assert got["a"] == 20 and got["d"] == 0 and got[None] == 100
    assert got["b"] == pytest.approx(180) and got["c"] == pytest.approx(90)


def test_mix_edges(spark):
    df = edge(spark)
    rows = mixing.mix(df, buckets=4).collect()
    assert len(rows) == 7
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size
        assert r["__text"] == "q"
    again = sorted((r.doc_id or 0, r.taken) for r in mixing.mix(df.repartition(5), buckets=9).collect())
    assert again == sorted((r.doc_id or 0, r.taken) for r in rows)  # neither partitions nor ranges matter
    assert mixing.mix(df.limit(0)).count() == 0
    whole = mixing.mixed_documents(df)
    assert whole.columns == df.columns and whole.count() == sum(r.copies for r in rows)


def test_mix_meets_targets(spark):
    rows = mixing.mix(table(spark, "/root/testdata/sf0.01", "documents")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("largest")).collect()
    assert all(abs(r.taken - r.target) <= r.largest / 2 + 1 for r in rows)


@pytest.mark.parametrize("weight", [0.02, 1 / 21, 1.0, 30.0, "mixed"])
def test_mix_ranges_stay_small_at_any_weight(spark, weight, monkeypatch):
    """The largest key range of a source, as a share of its rows, with weights far from 1."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("one word").alias("text"), F.lit("a").alias("source"),
                                      F.when(F.col("id") % 3 == 0, 0.01).when(F.col("id") % 3 == 1, 1.0).otherwise(50.0).alias("score"))
    quality = F.col("score") if weight == "mixed" else F.lit(weight)
    kept, cut = [], mixing.cut_lineage
    monkeypatch.setattr(mixing, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    out = mixing.mix(rows, quality=quality, buckets=64)
    largest = kept[0].agg(F.max("__n")).first()[0]
    assert largest < 2 * 60_000 * 0.26 / 64 * 1.5
    taken = out.agg(F.sum("taken")).first()[0]
    assert abs(taken - 1.5 * 120_000) <= 2
    if weight == "mixed":  # good documents are in the sampled half more often
        odds = {r.score: r.share for r in out.groupBy("score").agg(F.avg((F.col("copies") == 2).cast("int")).alias("share")).collect()}
        assert odds[50.0] > 0.9 > odds[1.0] > odds[0.01]


def test_mix_rows_without_ids_spread(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.lit("a").alias("source"))
    taken = mixing.mix(rows)
    assert abs(taken.agg(F.sum("taken")).first()[0] - 9000) <= 2 and taken.where("copies = 2").count() == 1500


def test_common_words_are_looked_up_by_length(spark):
    """A word meets the common words of its length in bytes only; others are none of them."""
    text = "a a a a éé éé éé fünf fünf wortlang x, x, 12 12 12 12 12 unbekanntes"
    docs = spark.createDataFrame([(1, text, "de"), (2, "", "de"), (3, None, None)], "doc_id long, text string, lang string")
    codes = {r.lang__: r.codes__ for r in quality_rules.common_words(docs, "text", "lang").collect()}
    assert list(codes) == ["de"] and [len(m) for m in codes["de"]] == [1, 1, 0, 1, 1, 0, 0, 1, 0, 0, 1]
    assert all(len(w.encode()) == n for n, m in enumerate(codes["de"], 1) for w in m)
    got = {r.doc_id: r.words__ for r in quality_rules.measured(docs).collect()}
    counts = collections.Counter(text.split())
    known = sorted((w for w in counts if any(c.isalpha() for c in w)), key=lambda w: (-counts[w], w))
    assert got[1] == [float(counts[w]) for w in known] + [0.0] * (quality_rules.COMMON - len(known)) + [float(counts["12"])]
    assert got[2] == [0.0] * (quality_rules.COMMON + 1) == got[3]
