"""Spelling variants, SentencePiece ids and embedding whitening."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vecdex.llm import piece_bpe, spelling, whitening
from vecdex.llm.registry import QUERIES
from vecdex.llm.tokens import vocabulary
from vecdex.session import Scratch
from vecdex.sources.tables import table

SF = "/root/testdata/sf0.001"
MODEL = vocabulary("piece_bpe_32k.model")


# -- op11 ------------------------------------------------------------------------

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def deletions(w):
    return {w[:k] + w[k + 1:] for k in range(len(w))}


def brute_variants(docs):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    by_deletion = {}
    for w in count:
        for d in deletions(w) | {w}:
            by_deletion.setdefault(d, set()).add(w)
    near = {w: {v for d in deletions(w) | {w} for v in by_deletion[d] if one_edit(w, v)} for w in count}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 5 * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None)
    return out


def as_dict(rows):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op11_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want = brute_variants(docs)
    assert as_dict(QUERIES["op11_spelling"](spark, sf).collect()) == want and want


def variant_docs(seed):
    """Words over few letters, so that lists are dense, with chains of forms."""
    r = random.Random(seed)
    base = ["".join(r.choice("abé") for _ in range(r.randint(5, 8))) for _ in range(150)]
    docs = []
    for k, w in enumerate(base):
        docs.append((k, f"{w.upper()} " * r.choice([1, 5, 30, 200, 1000])))
        for _ in range(6):
            at, kind = r.randrange(len(w)), r.randrange(3)
            v = w[:at] + (r.choice("abé") if kind else "") + w[at + (kind != 2):]
            docs.append((1000 + k, f"{v}-" * r.choice([1, 5, 6, 25, 40])))
    return docs


def test_op11_dense_lists_and_blocks(spark, monkeypatch):
    docs = variant_docs(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute_variants(docs)
    assert as_dict(spelling.variants(df).collect()) == want
    assert sum(1 for f, *_ in want.values() if f) > 20 and any(root != form for form, root, *_ in want.values() if form)
    words = spelling.word_counts(df)
    for size in (3, 10, 20_000):  # lists dealt into blocks of a few words lose nothing
        rows = spelling.near_words(words, Scratch(spark, "t"), size).collect()
        assert {r.word: r.n_near for r in rows} == {w: v[3] for w, v in want.items() if v[3]}
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == {w: v[2] for w, v in want.items()}


def test_op11_scan_against_all_pairs():
    r = random.Random(5)
    for _ in range(300):
        words = sorted({"".join(r.choice("ab") for _ in range(r.randint(1, 7))) for _ in range(r.randint(1, 60))})
        shared = [0, *map(spelling.common_prefix, words, words[1:])]
        jump = spelling.jumps(shared)
        for q in words:
            assert spelling.near_positions(q, words, shared, jump) == [k for k, w in enumerate(words) if one_edit(q, w)]


def test_op11_long_chain_of_forms(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(13)], "word string, form string")
    got = {r.word: r.root for r in spelling.roots(forms, Scratch(spark, "t")).collect()}
    assert got == {f"w{k}": "w13" for k in range(13)}


def test_op11_edges(spark):
    schema = "doc_id long, text string, word string, n int, form string"
    rows = [(None, "orange " * 5, "x", 1, "y"), (1, None, None, None, None), (2, "", "q", 2, None),
            (3, "orangé " * 30, "", 0, ""), (3, "orangé " * 30, "", 0, ""), (4, "Orangé×÷ short " * 9, "", 0, ""), (5, "b" * 100_000, "", 0, "")]
    df = spark.createDataFrame(rows, schema)
    got = as_dict(spelling.variants(df).collect())
    want = brute_variants([("" if r[0] is None else r[0], r[1]) for r in rows])
    assert got == want and got["orange"][0] == "orangé"
    assert spelling.variants(df.limit(0)).count() == 0
    assert spelling.variants(df.where("doc_id in (1, 2)")).count() == 0


# -- op12 ------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op12_against_library(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = {}
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = sp.encode(r.text or "")
        want[r.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(sp.decode(ids)))
    rows = QUERIES["op12_pieces"](spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want and len(rows) == len(want)


PARTS = ["a", "b", "ing", "the ", " ", "  ", "    ", "\n", "▁", "é", "日", "本", "\U0001F600", "\x00", "\t", "ab", "aaaa", "1", "00", ".", "=====", "ĦĦ",
         "<s>", "<0x0A>", "in", "n", "g", "th", "e", " " * 17, "\r", "　", "가", "क्ष", "x" * 70]


def test_op12_odd_texts():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(7)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, r.choice([3, 20, 200])))) for _ in range(4000)]
    texts += ["", "a" * 5000, " " * 5000, "ab" * 3000, "\n" * 3000, "日本" * 3000,
              "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30_000))]
    for limit in (0, 500, 100_000):  # with no memory, one that fills up, and a large one
        own = piece_bpe.Encoder(MODEL, limit)
        got = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 64) for b in own.encode(texts[k:k + 64])]
        assert got == sp.encode(texts)
    assert [own.model.decode(np.array(i, np.int64)) for i in got] == [sp.decode(i) for i in got]


def test_op12_decodes_any_ids():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own, r = piece_bpe.PieceModel(MODEL), random.Random(9)
    for _ in range(3000):
        ids = [r.randrange(32_000) if r.random() < 0.5 else r.randrange(3, 259) for _ in range(r.randint(0, 30))]
        assert own.decode(np.array(ids, np.int64)) == sp.decode(ids), ids


def test_op12_merges_whose_order_matters():
    """Where a merge makes a pair as good as its own, one pair at a time gives the model's order."""
    own = piece_bpe.PieceModel(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for word in ("▁" * n for n in (2, 3, 5, 7, 15, 16, 17, 31, 100)):
        symbols = own.char[np.array([ord(c) for c in word])]
        assert own._one_by_one(symbols).tolist() == sp.encode(word[1:].replace("▁", " "))
    with pytest.raises(Exception):
        piece_bpe.PieceModel(vocabulary("word_bpe_49k.json"))


def test_op12_edges(spark):
    rows = [(None, None, [1], "x"), (None, "a b", None, "x"), (1, "", [], ""), (1, "a b", [2], None), (2, " ", [3], "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string")
    both = piece_bpe.decoded(piece_bpe.encoded(df, MODEL), MODEL)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in both.collect()) == sorted(
        [("None", [], ""), ("None", [264, 287], "a b"), ("1", [], ""), ("1", [264, 287], "a b"), ("2", [259], " ")])
    once = piece_bpe.round_trip(df, MODEL)
    assert sorted(map(str, once.collect())) == sorted(map(str, both.collect())) and once.columns == both.columns
    assert piece_bpe.decoded(piece_bpe.encoded(df.limit(0), MODEL), MODEL).count() == 0
    again = piece_bpe.decoded(df.select("ids", "decoded", "doc_id"), MODEL)  # null lists; a clashing column is replaced
    assert again.columns == ["ids", "doc_id", "decoded"]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [r.decoded for r in again.collect()] == [sp.decode(r[2]) if r[2] else "" for r in rows]


# -- op13 ------------------------------------------------------------------------

def check_whitened(rows, vectors, components=32):
    """Against numpy's eigenvectors; vectors as (id, list) in any order."""
    fine = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in fine], np.int64)
    n, sums = len(x), x.sum(axis=0)
    apart = ((n * x - sums) ** 2).sum(axis=1)
    away = (n * x - sums) / n
    v = away.T @ away / n
    e = np.linalg.eigvalsh(v)[::-1]
    k = min(components, int((e > 1e-12 * max(e[0], 1e-300)).sum()))
    assert len(rows) == n * k
    ids = [i for i, _ in fine]
    place = {i: p for p, i in enumerate(ids)}
    y = np.full((n, k), np.nan)
    for r in rows:
        y[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == apart[place[r["vec_id"]]]
        assert abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9
    assert np.abs(y.T @ y / n - np.eye(k)).max() < 1e-9 and np.abs(y.mean(axis=0)).max() < 1e-9
    assert max(r["identity_error"] for r in rows) < 1e-9 and len({r["identity_error"] for r in rows}) == 1
    # y = away w with w e-scaled unit eigenvectors
    w = np.linalg.lstsq(away, y, rcond=None)[0] * np.sqrt(e[:k])
    if k == away.shape[1]:
        assert np.abs(v @ w - w * e[:k]).max() < 1e-8 * e[0] and np.abs(np.linalg.norm(w, axis=0) - 1).max() < 1e-8
    assert np.abs(v @ (away.T @ y) / np.linalg.norm(away.T @ y, axis=0) - (away.T @ y) / np.linalg.norm(away.T @ y, axis=0) * e[:k]).max() < 1e-7 * e[0]


def test_op13_against_numpy(spark):
    vectors = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    check_whitened(QUERIES["op13_whitening"](spark, "/root/testdata/sf0.01").collect(), vectors)


def test_op13_edges(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    r = np.random.default_rng(3)
    vectors = [(k, [float(c) for c in v]) for k, v in enumerate(r.normal(size=(60, 5)))]
    vectors += [(100 + k, vectors[k][1]) for k in range(5)]  # repeated vectors
    rows = vectors + [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [1.0, float("nan"), 0.0, 0.0, 0.0]), (203, [1.0, 0.0, float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(*x, "n", 1) for x in rows], "vec_id long, embedding array<float>, id string, n int").repartition(7)
    got = whitening.whitened(df).collect()
    as_float = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    check_whitened(got, as_float)
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(df.where("vec_id = 3")).count() == 0          # one vector has no variance
    assert whitening.whitened(df.where("vec_id >= 200")).count() == 0
    assert len({r["component"] for r in whitening.whitened(df.where("vec_id < 3")).collect()}) == 2
    some = df.select("vec_id", F.expr("array_repeat(embedding[0], 4)").alias("embedding")).where("vec_id < 100")
    assert {r["component"] for r in whitening.whitened(some).collect()} == {1}   # equal dimensions
    with pytest.raises(Exception, match="width"):
        whitening.whitened(df.where("vec_id < 9").unionByName(df.limit(1).select("vec_id", F.array(F.lit(1.0).cast("float")).alias("embedding"), "id", "n"))).count()


def test_op13_large_numbers_are_exact(spark):
    df = spark.createDataFrame([(0, [1e12, 0.0]), (1, [-1e12, 3.0]), (2, [5e11, 1.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whitened(df).collect()}
    x = [[64 * 10 ** 12, 0], [-64 * 10 ** 12, 192], [32 * 10 ** 12, 64]]
    sums = [sum(c) for c in zip(*x)]
    assert got == {k: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for k, v in enumerate(x)}


@pytest.mark.parametrize("kind", ["random", "graded", "equal", "rank", "small", "pairs", "glued"])
def test_op13_solver(kind):
    r = np.random.default_rng(11)
    x = {"random": lambda: r.normal(size=(900, 48)),
         "graded": lambda: r.normal(size=(900, 48)) * np.logspace(0, -6, 48),
         "equal": lambda: np.repeat(np.vstack([np.eye(40), -np.eye(40)]), 2, axis=0),
         "rank": lambda: r.normal(size=(900, 3)) @ r.normal(size=(3, 48)),
         "small": lambda: r.normal(size=(5, 48)),
         "pairs": lambda: np.hstack([r.normal(size=(900, 10)), np.zeros((900, 3)), np.ones((900, 4))]),
         "glued": lambda: np.diag(np.abs(np.arange(10, -11, -1)) * 1.0) + np.eye(21, k=1) + np.eye(21, k=-1)}[kind]()
    x = x - x.mean(axis=0)
    n, dim = x.shape
    factor = np.linalg.qr(np.vstack([np.zeros((dim, dim)), x]), mode="r")
    e, z = whitening.directions(factor, n, dim)
    v = x.T @ x / n
    want = np.linalg.svd(x)[1] ** 2 / n
    assert len(e) == (want > 1e-24 * want[0]).sum() if kind not in ("rank", "small", "pairs", "equal", "glued") else len(e) <= len(want)
    assert len(e) == int((want > 1e-13 * want[0]).sum())
    assert np.abs(e / want[:len(e)] - 1).max() < 1e-9
    assert np.abs(z.T @ z - np.eye(len(e))).max() < 1e-10 and np.linalg.norm(v @ z - z * e, axis=0).max() < 1e-12 * e[0]
    y = x @ (z / np.sqrt(e))
    assert np.abs(y.T @ y / n - np.eye(len(e))).max() < 1e-8
