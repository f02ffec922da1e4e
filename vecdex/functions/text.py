"""Text rules as Column expressions: P1-P5, P8, P14, F1, F2, F7.

Every function maps Column -> Column and stays inside the JVM (regular
expressions and string built-ins), so it fuses into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) --------------------
SNIPPET_CHARS = 300            # corpus snippet length, in code points
DISPLAY_CHARS = 200            # result-card snippet length
LOG_PREVIEW_CHARS = 50         # query preview length
MAX_QUERY_UTF16 = 500          # query length cap, UTF-16 code units
DEFAULT_LIMIT = 10
MAX_LIMIT = 50
MIN_LIMIT = 1
SUGGEST_MIN_CHARS = 2
SUGGEST_LIMIT = 3
MSG_BLANK = "Query parameter 'q' must not be blank"
MSG_TOO_LONG = "Query parameter 'q' exceeds maximum length of 500 characters"
MSG_LIMIT = "Limit must be at least 1"
# Characters for which java.lang.Character.isWhitespace is true (String.isBlank).
JAVA_WHITESPACE = (r"\x{09}-\x{0D}\x{1C}-\x{20}\x{1680}\x{2000}-\x{2006}"
                   r"\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}")
# Characters removed by JavaScript String.prototype.trim (WhiteSpace + LineTerminator).
JS_TRIM_CHARS = (r"\x{09}-\x{0D}\x{20}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
                 r"\x{202F}\x{205F}\x{3000}\x{FEFF}")
# HTML escape order: '&' first so later entities are not escaped twice.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
GENRE_CHIP = ('<span class="genre-tag">', "</span>")   # result-card genre markup
# strict release date shape YYYY-MM-DD (no calendar check)
FULL_DATE_RE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
BARE_YEAR_RE = r"\A[0-9]{4}\z"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def release_year(raw, allow_bare_year: bool = False) -> Column:
    """Year of a strict ``YYYY-MM-DD`` string, else null.

    ``allow_bare_year`` gives the documented variant that also accepts ``YYYY``."""
    raw = _c(raw)
    ok = raw.rlike(FULL_DATE_RE)
    if allow_bare_year:
        ok = ok | raw.rlike(BARE_YEAR_RE)
    return F.when(ok, F.substring(raw, 1, 4).cast("int"))


def json_values(c, strict: bool = True) -> Column:
    """Values of a JSON object, in document order.

    A duplicated key keeps its first position and its last value (the
    behaviour of a Python dict). ``strict`` makes malformed JSON a task
    failure; otherwise it yields null."""
    opts = {"mode": "FAILFAST"} if strict else {}
    entries = F.map_entries(F.from_json(_c(c), "map<string,string>", opts))
    keys = F.transform(entries, lambda e: e["key"])
    first_pos = F.filter(F.sequence(F.lit(1), F.size(entries)),
                         lambda i: F.array_position(keys, F.element_at(keys, i)) == i)
    return F.when(F.size(entries) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(first_pos, lambda i: F.element_at(
            F.filter(entries, lambda e: e["key"] == F.element_at(keys, i)), -1)["value"]))


def prefix(c, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(_c(c), 1, n)


def utf16_prefix(c, n: int) -> Column:
    """First ``n`` UTF-16 code units, as Java and JavaScript cut strings; a
    surrogate pair that the cut would split is left out."""
    c = _c(c)
    units = F.encode(c, "UTF-16BE")
    last = F.hex(F.substring(units, 2 * n - 1, 1))
    end = F.when(last.between("D8", "DB"), 2 * n - 2).otherwise(2 * n)
    cut = F.decode(F.substring(units, F.lit(1), end), "UTF-16BE")
    return F.when(F.length(c) * 2 <= n, c).when(F.octet_length(units) <= 2 * n, c).otherwise(cut)


def display_snippet(c, n: int = DISPLAY_CHARS, ellipsis: bool = False) -> Column:
    """Null -> '' then first ``n`` UTF-16 units; optional ellipsis."""
    s = F.coalesce(_c(c), F.lit(""))
    if not ellipsis:
        return utf16_prefix(s, n)
    return F.when(utf16_length(s) > n, F.concat(utf16_prefix(s, n), F.lit("…"))).otherwise(s)


def poster_url(path, base: str) -> Column:
    """P5: base + path; a null path stays null."""
    return F.concat(F.lit(base), _c(path))


def html_escape(c, null_as: str | None = None) -> Column:
    """Escape & < > \" in that order. A null stays null, or becomes
    ``null_as`` (the result page stringifies a missing title to 'null')."""
    out = _c(c) if null_as is None else F.coalesce(_c(c), F.lit(null_as))
    for a, b in HTML_ESCAPES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def render_genres(genres) -> Column:
    """Escaped genre chips joined without separator; null list -> ''."""
    return F.array_join(F.transform(F.coalesce(_c(genres), F.array().cast("array<string>")),
                                    lambda g: F.concat(F.lit(GENRE_CHIP[0]), html_escape(g, "null"),
                                                       F.lit(GENRE_CHIP[1]))), "")


def render_year(year) -> Column:
    """Year shown as text; a missing year renders as ''."""
    return F.coalesce(_c(year).cast("string"), F.lit(""))


def js_trim(c) -> Column:
    """JavaScript ``trim()`` (drops NBSP, ideographic space, BOM too)."""
    return F.regexp_replace(_c(c), rf"\A[{JS_TRIM_CHARS}]+|[{JS_TRIM_CHARS}]+\z", "")


def utf16_length(c) -> Column:
    """Java ``String.length()``: UTF-16 code units (an emoji counts 2)."""
    return (F.octet_length(F.encode(_c(c), "UTF-16BE")) / 2).cast("int")


def is_blank(c) -> Column:
    """Java ``String.isBlank`` (null counts as blank; NBSP is not whitespace)."""
    c = _c(c)
    return c.isNull() | c.rlike(rf"\A[{JAVA_WHITESPACE}]*\z")


def effective_limit(limit) -> Column:
    """default 10 when absent, clamp to 50."""
    return F.least(F.coalesce(_c(limit), F.lit(DEFAULT_LIMIT)), F.lit(MAX_LIMIT))


def validation_error(query, limit) -> Column:
    """first failing rule wins (blank, too long, limit < 1); null when valid."""
    lim = F.coalesce(_c(limit), F.lit(DEFAULT_LIMIT))
    return (F.when(is_blank(query), F.lit(MSG_BLANK))
            .when(utf16_length(query) > MAX_QUERY_UTF16, F.lit(MSG_TOO_LONG))
            .when(lim < MIN_LIMIT, F.lit(MSG_LIMIT)))


def suggest_eligible(query) -> Column:
    """trimmed query has at least two UTF-16 units."""
    return F.coalesce(utf16_length(js_trim(query)) >= SUGGEST_MIN_CHARS, F.lit(False))


def line_count_label(n) -> Column:
    """Thousands-separated count, e.g. 42306 -> '42,306'."""
    return F.format_number(_c(n).cast("long"), 0)
