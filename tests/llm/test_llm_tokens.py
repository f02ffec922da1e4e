"""Encoding, counting, packing and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from vecdex.llm import packing, token_counts, token_files, tokens
from vecdex.llm.registry import QUERIES
from vecdex.sources.tables import table

SF = "/root/testdata/sf0.001"
WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
PARTS = ["a", "Foo", "bar.", "'s", "don't", "  ", " ", "\n", "\t", "\r\n", "\x85", "\xa0", "é", "é", "ΑΣ", "İ", "<|endoftext|>",
         "<|startoftext|>", "12", "3½", "!!", "\x1c", " ", "ß", "한", "가", "😀", "|", "x)", "...", "​", "́", "#",
         "word!!'s", "(a)", "क़", "aaaa", "======="]
EDGE = "doc_id long, text string, lang string, source string, n_chars long, length long, sequence_id string, offset int, piece string"
ROWS = [(1, None, None, None, None, 1, "x", 1, "p"), (1, None, None, None, None, 1, "x", 1, "p"), (None, "", "en", "s", 0, 1, "x", 1, "p"),
        (2, "Hello  world <|endoftext|> again", "en", "s", 3, 1, "x", 1, "p"), (3, "word " * 9000, "en", "s", 3, 1, "x", 1, "p"),
        (4, "z" * 30000, "en", "s", 3, 1, "x", 1, "p")]


def strings(n=1500):
    r = random.Random(7)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)] + [
        "z" * 3000, " " * 500 + "a" + "\n" * 90, "ab  c\n\n d\t e " * 30, ""]


def library(name):
    t = Tokenizer.from_file(tokens.vocabulary(name))
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_encoder_equals_library(name):
    encode, want = tokens.IdEncoder(tokens.vocabulary(name), 50).encode, library(name)
    for text in strings():
        assert encode(text) == want(text).tobytes(), repr(text[:80])


def test_counts_equal_library():
    want, own = library(WORD), token_counts.Counter(tokens.vocabulary(WORD), 40)
    texts = strings()
    for at in range(0, len(texts), 200):
        part = texts[at:at + 200]
        assert own.counts(part) == [len(want(t)) for t in part]


def test_merging_runs_of_equal_pairs():
    t = token_counts.MergeTable(tokens.vocabulary(WORD))
    want = library(WORD)
    for text in ("!" * 77, "=" * 64, "a" * 33, "ha" * 50):
        assert t.count([text.encode()])[0] == len(want(text))


def test_op3_against_library(spark):
    want = library(WORD)
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op3_token_counts"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        n = len(want(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


def test_op3_edges(spark):
    df = spark.createDataFrame(ROWS, EDGE)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df).collect())
    assert [g[:2] for g in got] == [(0, 0), (1, 0), (1, 0), (2, 32), (3, 45000), (4, 30000)]
    assert got[4][2] == 9000
    assert token_counts.token_counts(df.limit(0)).count() == 0


def check_packed(rows, documents, capacity=2048):
    """Every piece of every document stands once, and sequences have no gaps."""
    want = {}
    for key, ids in documents:
        ids = np.append(ids, np.uint32(0))
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.setdefault((key, k, at, len(part), zlib.crc32(part.astype("<u4").tobytes())), []).append(1)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert len(got) == sum(map(len, want.values())) and set(got) == set(want)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert at[r.sequence_id] <= capacity
    return len(at), sum(r.length for r in rows)


def test_op2_against_library(spark):
    want = library(WORD)
    docs = [(r.doc_id, want(r.text)) for r in table(spark, SF, "documents").collect()]
    used, total = check_packed(QUERIES["op2_pack"](spark, SF).collect(), docs)
    assert used <= -(-total // 2048) + 1


def test_op2_edges_and_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)  # many buckets for the common length
    df = spark.createDataFrame(ROWS + [(k, "same words here", "en", "s", 1, 1, "x", 1, "p") for k in range(10, 50)], EDGE)
    want = library(WORD)
    docs = [(r.doc_id, want(r.text)) for r in df.collect()]
    rows = packing.pack(packing.document_pieces(df, with_ids=True)).collect()
    check_packed(rows, docs)
    whole = packing.packed_sequences(packing.pack(packing.document_pieces(df, with_ids=True))).collect()
    assert sum(r.length for r in whole) == sum(len(i) + 1 for _, i in docs)
    assert packing.pack(packing.document_pieces(df.limit(0))).count() == 0


def test_pack_rejects_impossible_lengths(spark):
    for bad in (0, None, 2049):
        with pytest.raises(Exception, match="tokens"):
            packing.pack(spark.createDataFrame([(1, 0, bad)], "doc_id long, piece int, length long")).count()


def test_minimum_bin_slack_fills_bins():
    r = random.Random(3)
    for _ in range(200):  # the dynamic program against all subsets
        counts = {r.randint(1, 12): r.randint(1, 3) for _ in range(4)}
        room = r.randint(1, 30)
        best, sums = 0, {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= room}
            best = max(sums)
        taken = packing.fullest(counts, room)
        assert sum(n * k for n, k in taken.items()) == best and all(k <= counts[n] for n, k in taken.items())
    histogram = {r.randint(1, 2048): r.randint(1, 400) for _ in range(300)}
    slots, bins = packing.plan_bins(histogram)
    total = sum(n * c for n, c in histogram.items())
    assert bins <= 1.08 * total / 2048  # few distinct lengths and no small ones: no better fit exists for many
    assert len(np.unique(slots.sequence)) <= 2 * len(histogram)


def _model():
    freq = token_files.quantised({k: 1 + 10 ** 6 // (k + 1) for k in range(3000)})
    return token_files.Model(np.array(list(freq)), np.array(list(freq.values())))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000, 400_000])
def test_block_round_trip(n):
    model = _model()
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 2999).astype(np.int64)
    block = token_files.encode_block(ids, model, lanes=128, every=256)
    assert (token_files.decode_block(block, model) == ids).all()
    for k in reversed(range(len(block.words))):  # any segment alone
        part = token_files.decode_segment(block, model, k)
        assert (part == ids[k * 256 * block.lanes:][:len(part)]).all()
    if n > 5:
        block.crc32 ^= 1
        with pytest.raises(ValueError, match="checksum"):
            token_files.decode_block(block, model)


def test_frequencies_sum_to_scale():
    for counts in ({5: 1}, {k: 1 for k in range(50_000)}, {1: 10 ** 12, 2: 1}, {}):
        freq = token_files.quantised(counts)
        assert set(freq) == set(counts) and (not counts or sum(freq.values()) == 1 << token_files.SCALE)
        assert all(f > 0 for f in freq.values())


def test_op4_against_library(spark):
    want = library(BYTE)
    start = 0
    got = {r.doc_id: r for r in QUERIES["op4_token_files"](spark, SF).collect()}
    for r in table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = np.append(want(r.text), np.uint32(0))
        assert tuple(got[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        start += len(ids)


def test_op4_edges(spark, tmp_path):
    df = spark.createDataFrame(ROWS, EDGE)
    token_files.write_files(df, str(tmp_path / "f"), block=50)
    rows = sorted(token_files.read_files(spark, str(tmp_path / "f"), with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4]
    want = library(BYTE)
    texts = {None: "", 1: None, **{r[0]: r[1] for r in ROWS[3:]}}
    start = 0
    for r in rows:
        assert r.start == start and r.ids == [*want(texts[r.doc_id]).tolist(), 0]
        start += r.n_tokens
    token_files.write_files(df.limit(0), str(tmp_path / "e"))
    assert token_files.read_files(spark, str(tmp_path / "e")).count() == 0
