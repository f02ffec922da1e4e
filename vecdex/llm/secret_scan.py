"""Secret scans: fixed patterns, and a randomness test battery for the rest.

Patterns find assignments, access keys and long hexadecimal runs. Other long
runs of token characters are tested. The smallest alphabet that covers a run
(hex, base 32, lower-case, alphanumeric, base 64) is its inferred encoding; under
it three tests ask whether the symbols look random: chi-squared uniformity over
the alphabet, Wald-Wolfowitz runs about its middle, and lag-1 serial
correlation. Fisher's method joins their p-values; a run that they reject is
no secret. A run with separators, such as a UUID or a key in groups of five, is
tested as it stands and without them; its span is that of the whole run.

Passing is weak evidence for a short run, so false discoveries are controlled
by length: the likelihood ratio of uniform symbols against ordinary text
(letter frequencies, sticky character classes) is an e-value, which grows with
the length of a random run only; the mean over the two readings of a run is one
too. The e-value form of the Benjamini-Hochberg procedure picks runs over the
whole table, so that at most a share ``ALPHA`` of what is picked among ordinary
runs is false: a first pass scores every run and counts them, a histogram of the
scores gives the level, and a second step applies it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.session import Scratch

KINDS = ("assign", "access", "hex", "random")
ALPHA, PASS_LEVEL, MIN_RUN = 0.001, 0.005, 16
#: no e-value below 1 / ALPHA is ever picked
LEAST = -math.log(ALPHA)
#: ranges of the score per unit, and the score from which all count as one
STEPS, TOP = 64, 400.0
_NO_SEPARATORS = str.maketrans("", "", "-_")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_ASSIGN = re.compile("(" + "|".join(
    _any_case(k) for k in _KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_GATE = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALPHABETS = [(a, {c: i for i, c in enumerate(a)}) for a in (
    _DIGIT + "abcdef", _DIGIT + "ABCDEF", _LOWER, _UPPER + "234567", _DIGIT + _LOWER, _DIGIT + _UPPER,
    _DIGIT + _UPPER + _LOWER, _UPPER + _LOWER + _DIGIT + "+/", _UPPER + _LOWER + _DIGIT + "-_", _UPPER + _LOWER + _DIGIT + "+/-_=")]
#: letters per thousand in ordinary text, a to z
_LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
_LETTER_LOG = {c: math.log(n / sum(_LETTERS)) for c, n in zip(_LOWER, _LETTERS, strict=True)}
_STAY, _SWITCH = math.log(0.93), math.log(0.07 / 3)


def chi_squared_tail(x: float, df: int) -> float:
    """P(chi-squared with df degrees of freedom >= x)."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:  # series of the lower part
        term = total = 1 / a
        k = a
        while term > total * 1e-12:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - front * total)
    b = x + 1 - a  # continued fraction of the upper part
    c, d = 1e300, 1 / b
    value = d
    for k in range(1, 400):
        step = -k * (k - a)
        b += 2
        d = 1 / (step * d + b) if step * d + b else 1e300
        c = b + step / c if c else 1e-300
        value *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return min(1.0, front * value)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def encoding(run: str) -> tuple[str, list[int]]:
    """The smallest covering alphabet and the run's symbols in it."""
    body = run.rstrip("=") or run
    seen = set(body)
    for alphabet, index in _ALPHABETS:
        if seen <= index.keys():
            return alphabet, [index[c] for c in body]
    raise ValueError("a run holds token characters only")


def battery(symbols: list[int], size: int) -> tuple[float, float, float, float]:
    """p-values under randomness: uniformity, runs, serial correlation, joined."""
    n = len(symbols)
    counts: dict[int, int] = {}
    for s in symbols:
        counts[s] = counts.get(s, 0) + 1
    uniform = chi_squared_tail(sum(c * c for c in counts.values()) * size / n - n, size - 1)
    upper = [s * 2 >= size for s in symbols]
    a = sum(upper)
    b = n - a
    if a and b:
        found = 1 + sum(x != y for x, y in zip(upper, upper[1:]))
        mean = 1 + 2 * a * b / n
        spread = (mean - 1) * (mean - 2) / max(1, n - 1)
        runs = _two_sided((found - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        runs = 2.0 ** (1 - n)
    mean = sum(symbols) / n
    off = [s - mean for s in symbols]
    power = sum(x * x for x in off)
    serial = _two_sided((sum(x * y for x, y in zip(off, off[1:])) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    joined = chi_squared_tail(-2 * sum(math.log(max(p, 1e-300)) for p in (uniform, runs, serial)), 6)
    return uniform, runs, serial, joined


def log_e_value(run: str, size: int) -> float:
    """log of P(run | uniform symbols) / P(run | ordinary text)."""
    text, last = 0.0, ""
    for c in run:
        kind = "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "-"
        text += _STAY if kind == last else math.log(0.25) if not last else _SWITCH
        text += _LETTER_LOG[c.lower()] if kind in "aA" else math.log(0.1) if kind == "0" else math.log(0.2)
        last = kind
    return -len(run) * math.log(size) - text


def run_score(run: str) -> float:
    """log of a run's e-value, over its readings with and without separators; a
    reading that the battery rejects counts as nothing."""
    body = run.rstrip("=") or run
    plain = body.translate(_NO_SEPARATORS)
    values = []
    for reading in {body, plain} if len(plain) >= MIN_RUN else {body}:
        alphabet, symbols = encoding(reading)
        passes = battery(symbols, len(alphabet))[3] >= PASS_LEVEL
        values.append(log_e_value(reading, len(alphabet)) if passes else -math.inf)
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values) / len(values)) if top > -math.inf else top


def pick_level(counts: dict[float, int], tested: int, alpha: float = ALPHA) -> float:
    """The score from which runs are picked: the lowest at which, for the ``k`` runs
    at or above it, the e-value reaches ``tested / (alpha k)``. ``counts`` holds the
    number of runs per score, or per lower edge of a range of scores."""
    level, k = math.inf, 0
    for score in sorted(counts, reverse=True):
        k += counts[score]
        if score >= math.log(tested / (alpha * k)):
            level = score
    return level


def random_runs(runs: list[str], alpha: float = ALPHA) -> list[bool]:
    """Which of a list of runs are secrets, under false-discovery control."""
    scores = [run_score(run) for run in runs]
    level = pick_level(Counter(scores), len(runs), alpha)
    return [s >= level for s in scores]


def scored(text: str, floor: float = LEAST) -> tuple[list[tuple[int, int, int, float]], int]:
    """(kind number, start, end, score) in code points, end exclusive, by start, then
    kind, and the number of runs tested. Tested runs below ``floor`` are left out:
    no table makes the level less than ``LEAST``. Patterns have no score."""
    longest = max(map(len, text.split()), default=0)
    found: list[tuple[int, int, int, float]] = []
    tested = 0
    if longest >= 12:
        low = text.lower()
        if any(k in low for k in _GATE):
            found += [(0, m.start(), m.end(), math.inf) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if longest >= 16:
        if "AKIA" in text:
            found += [(1, m.start(), m.end(), math.inf) for m in _ACCESS.finditer(text)]
        found += [(2, m.start(), m.end(), math.inf) for m in _HEX.finditer(text)]
        taken = sorted((a, b) for _, a, b, _ in found)
        at = 0
        for m in _RUN.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if not any(a < m.end() and m.start() < b for a, b in taken[at:at + 4]):
                tested += 1
                score = run_score(m[0])
                if score >= floor:
                    found.append((3, m.start(), m.end(), score))
    return sorted(found, key=lambda s: (s[1], s[0])), tested


def spans(text: str, level: float = LEAST) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of one text, runs from a level on."""
    return [s[:3] for s in scored(text, level)[0]]


def _scores(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col, spans`` (with scores) and ``tested`` for every row."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(span)),
                           T.StructField("tested", T.LongType())])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scored(t or "") for t in batch.column(1).to_pylist()]
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "score": s} for k, a, b, s in own] for own, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), pa.array([n for _, n in found], pa.int64())], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def level_of(scores: DataFrame) -> float:
    """The level for a table of scored spans. Scores are counted in ranges of
    1 / ``STEPS``, all above ``TOP`` in one; a range counts at its lower edge, so the
    control holds. A row per range reaches the driver."""
    tested = scores.agg(F.sum("tested")).first()[0] or 0
    runs = scores.select(F.explode("spans").alias("s")).where("s.kind = 'random'")
    edge = F.floor(F.least(F.col("s.score"), F.lit(TOP)) * STEPS) / STEPS
    counts = {r["edge"]: r["n"] for r in runs.groupBy(edge.alias("edge")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return pick_level(counts, tested) if counts else math.inf


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans`` for every row; ``spans`` is an array of (kind, start,
    end) in code points, by start, then kind.

    Null and empty texts have no spans. Repeated rows and null ids are scanned
    like any other; an empty table gives an empty result. Columns besides the two
    named ones are not read. Texts are read once: scored spans are written to the
    shared folder, and the level that the whole table sets is applied to them.
    """
    scores = Scratch(docs.sparkSession, "secrets").write(_scores(docs, id_col, text_col))
    level = level_of(scores)
    picked = F.filter("spans", lambda s: (s["kind"] != "random") | (s["score"] >= F.lit(level)))
    return scores.select(id_col, F.transform(picked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def n_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def written(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``id_col, text_col`` with every span replaced by ``mark``; null text stays null.
    Texts are read twice, for the table's level and to replace."""
    work = Scratch(docs.sparkSession, "secrets")
    level = level_of(work.write(_scores(docs, id_col, text_col)))
    work.close()
    schema = T.StructType([docs.schema[id_col], docs.schema[text_col]])

    def blank(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for _, a, b in spans(text, level):
            if b > at:
                out += [text[at:max(a, at)], mark] if a >= at else []
                at = b
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([blank(t) for t in batch.column(1).to_pylist()], pa.string())], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
