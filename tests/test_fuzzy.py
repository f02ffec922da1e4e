"""Approximate title lookup against brute force."""

import random

import pytest

from pyspark.sql import functions as F

from vecdex.operators import fuzzy


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def strings(seed, n, letters="ab é", longest=14):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(0, longest))) for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        w = r.choice(base)
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(w))
            w = w[:at] + r.choice(["", *letters]) + w[at + r.randint(0, 1):]
        out.append(w)
    return out


@pytest.mark.parametrize("k,block", [(1, 4000), (2, 4000), (2, 7), (3, 20)])
def test_pairs_against_brute_force(spark, k, block):
    left, right = strings(k, 160), strings(k + 10, 160) + strings(k, 60)
    ldf = spark.createDataFrame([(s,) for s in left + [None]], "t string").repartition(3)
    rdf = spark.createDataFrame([(s,) for s in right + [None, right[0]]], "u string").repartition(4)
    got = sorted((r.l, r.r, r.edits) for r in fuzzy.similar_strings(ldf, rdf, k, block=block).collect())
    assert got == sorted((a, b, edits(a, b)) for a in set(left) for b in set(right) if edits(a, b) <= k)


def test_hot_grams_and_long_titles(spark):
    """Titles that share nearly all of their grams."""
    titles = [f"the collected chronicle volume {k:03d}" for k in range(150)]
    df = spark.createDataFrame([(s,) for s in titles], "t string")
    got = sorted((r.l, r.r, r.edits) for r in fuzzy.similar_strings(df, df, 1, block=10).collect())
    assert got == sorted((a, b, edits(a, b)) for a in titles for b in titles if edits(a, b) <= 1)


def test_lookup_rules(spark):
    cat = spark.createDataFrame([("Alpha Station", 1999, 1, "/a1"), ("Alpha Station", 2005, 2, "/a2"), ("Alpha Stations", 2005, 1, "/s"),
                                 ("Beta", 2001, 1, None), ("Beta", 2001, 2, "/b2"), ("Gamma", 2010, 1, ""), (None, 2000, 1, "/n"), ("It", 1990, 1, "/it")],
                                "title string, year int, rank int, poster_path string")
    pts = spark.createDataFrame([(1, " alpha statoin ", 2005, 0), (2, "Alpha Station", None, 0), (3, "ALPHA STATION", 2005, 0), (4, "Bta", 2001, 0),
                                 (5, "gama", 2010, 0), (6, "nothing like it", 2000, 0), (7, None, 2000, 0), (8, "Beta", 1950, 0), (9, "I", 1990, 0),
                                 (1, " alpha statoin ", 2005, 0), (10, "alpha stationss", None, 0)],
                                "id long, title string, release_year int, rank int")
    got = sorted((r.id, r.match_title, r.edits, r.poster_path) for r in fuzzy.fuzzy_lookup(pts, cat).collect())
    assert got == [(1, "alpha station", 2, "/a2"), (1, "alpha station", 2, "/a2"), (2, "alpha station", 0, "/a1"), (3, "alpha station", 0, "/a2"),
                   (4, "beta", 1, None), (5, "gamma", 1, None), (6, None, None, None), (7, None, None, None), (8, None, None, None),
                   (9, "it", 1, "/it"), (10, "alpha stations", 1, "/s")]
    assert fuzzy.fuzzy_lookup(pts.limit(0), cat).count() == 0
    assert all(r.match_title is None for r in fuzzy.fuzzy_lookup(pts, cat.limit(0)).collect())


def test_parity_bounds_edits_and_spares_distances(spark):
    """No pair within the edits is ruled out, and most of those beyond are."""
    words = strings(5, 90, letters="abcdefgh é😀", longest=20)
    df = spark.createDataFrame([(w,) for w in words], "s string").withColumn("odd", fuzzy.parity(F.col("s")))
    odd = {r.s: r.odd for r in df.collect()}
    far = kept = 0
    for a in odd:
        for b in odd:
            turned, n = ((odd[a] ^ odd[b]) & (2 ** 64 - 1)).bit_count(), edits(a, b)
            assert turned <= 2 * n
            far, kept = far + (n > 2), kept + (n > 2 and turned <= 4)
    assert kept < 0.8 * far
