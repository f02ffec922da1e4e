"""Scalar rules (P1-P5, P8, P14, F1, F2, F7, S4) on literal rows."""

import pytest
from pyspark.sql import functions as F

from vecdex.functions import text as tx


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,year,doc_year", [
    ("1999-05-17", 1999, 1999), ("1999", None, 1999), ("1999-05", None, None),
    ("", None, None), ("unknown", None, None), ("2000-99-99", 2000, 2000),
    ("2000-01-01\n", None, None), (None, None, None), ("12000-01-01", None, None),
])
def test_release_year(spark, raw, year, doc_year):
    assert one(spark, tx.release_year(F.col("s")), raw) == year
    assert one(spark, tx.release_year(F.col("s"), allow_bare_year=True), raw) == doc_year


def test_json_values_order_and_duplicates(spark):
    assert one(spark, tx.json_values("s"), '{"a": "Drama", "b": "Comedy"}') == ["Drama", "Comedy"]
    assert one(spark, tx.json_values("s"), "{}") == []
    # duplicate key: first position, last value (Python dict behaviour)
    assert one(spark, tx.json_values("s"), '{"a": "X", "b": "Y", "a": "Z"}') == ["Z", "Y"]


def test_json_values_malformed(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("{not json",)], "s string").select(tx.json_values("s")).collect()
    assert one(spark, tx.json_values("s", strict=False), "{not json") is None


def test_prefixes_count_code_points(spark):
    s = "a" * 299 + "😀" + "bcd"
    assert one(spark, tx.prefix("s", 300), s) == "a" * 299 + "😀"
    assert one(spark, tx.prefix("s", 300), "short") == "short"
    assert one(spark, tx.display_snippet("s"), None) == ""
    assert one(spark, tx.display_snippet("s", 3, ellipsis=True), "abcdef") == "abc…"


def test_poster_url_null_stays_null(spark):
    assert one(spark, tx.poster_url("s", "https://x/"), None) is None
    assert one(spark, tx.poster_url("s", "https://x/"), "/p.jpg") == "https://x//p.jpg"


def test_html_escape_order(spark):
    assert one(spark, tx.html_escape("s"), '<a href="x">&amp;</a>') == \
        "&lt;a href=&quot;x&quot;&gt;&amp;amp;&lt;/a&gt;"
    assert one(spark, tx.html_escape("s"), None) is None


def test_render_year_and_genres(spark):
    assert one(spark, tx.render_year(F.col("y")), None, "y int") == ""
    assert one(spark, tx.render_year(F.col("y")), 1999, "y int") == "1999"
    assert one(spark, tx.render_genres(F.col("g")), None, "g array<string>") == ""
    assert one(spark, tx.render_genres(F.col("g")), ["A&B"], "g array<string>") == \
        '<span class="genre-tag">A&amp;B</span>'
    assert one(spark, tx.html_escape("s", null_as="null"), None) == "null"


def test_js_trim(spark):
    assert one(spark, tx.js_trim("s"), " 　 hi there﻿\t") == "hi there"
    assert one(spark, tx.js_trim("s"), "   ") == ""


QUERY_CASES = [
    ("plain text", None, None, 10),
    ("plain text", 3, None, 3),
    ("plain text", 100, None, 50),
    ("東京の映画", None, None, 10),
    ("", None, tx.MSG_BLANK, 10),
    ("   ", None, tx.MSG_BLANK, 10),
    ("\t\n", None, tx.MSG_BLANK, 10),
    ("　", None, tx.MSG_BLANK, 10),
    (None, None, tx.MSG_BLANK, 10),
    (" ", None, None, 10),                 # NBSP is not whitespace in Java
    ("x" * 501, None, tx.MSG_TOO_LONG, 10),
    ("😀" * 251, None, tx.MSG_TOO_LONG, 10),     # 502 UTF-16 units
    ("x" * 500, None, None, 10),
    ("ok", 0, tx.MSG_LIMIT, 0),
    ("ok", -1, tx.MSG_LIMIT, -1),
    ("  ", 0, tx.MSG_BLANK, 0),                  # first failing rule wins
]


def test_validation_table(spark):
    df = spark.createDataFrame([(i, q, lim) for i, (q, lim, _, _) in enumerate(QUERY_CASES)],
                               "qid long, query string, limit int")
    from vecdex.operators.search import validate
    got = {r["qid"]: (r["error"], r["effective_limit"]) for r in validate(df).collect()}
    for i, (_, _, err, lim) in enumerate(QUERY_CASES):
        assert got[i] == (err, lim), QUERY_CASES[i]


def test_utf16_length_and_suggest(spark):
    assert one(spark, tx.utf16_length("s"), "😀") == 2
    assert one(spark, tx.suggest_eligible(F.col("s")), " a ") is False
    assert one(spark, tx.suggest_eligible(F.col("s")), " ab ") is True
    assert one(spark, tx.suggest_eligible(F.col("s")), None) is False


def test_line_count_label(spark):
    assert one(spark, tx.line_count_label(F.col("n")), 1234, "n long") == "1,234"
    assert one(spark, tx.line_count_label(F.col("n")), 42306, "n long") == "42,306"


def test_utf16_prefix(spark):
    texts = [None, "", "abc", "a😀b😀", "😀" * 4, "é" * 9, "x" * 5 + "😀"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 2, 3, 5, 6, 8):
        got = [r[0] for r in df.select(tx.utf16_prefix("t", n)).collect()]
        for t, g in zip(texts, got):
            want = None if t is None else t.encode("utf-16-le")[:2 * n].decode("utf-16-le", "ignore")
            assert g == want
