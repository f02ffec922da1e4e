"""Token counts by rank-synchronous array merging.

A batch's distinct pre-tokens lie in one flat (ragged) numpy array of symbols.
In each round every sequence finds the lowest rank among its adjacent pairs
and merges all places where that pair stands, left to right, at once; pairs
keep their ranks between rounds and only those beside a merge are looked up
again. Sequences without a mergeable pair leave the array, and what is left
of each is counted. Ranks, symbols, patterns and normalisation are read from
the vocabulary file. Counts of frequent pieces are remembered per worker, up
to a bound.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.llm.tokens import _WORDS, MEMO_LIMIT, vocabulary

_NONE = np.int64(1) << 40
#: symbols merged together; a longer pre-token makes a batch of its own
SYMBOLS = 1 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself where it is printable, else the next one from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class MergeTable:
    """Merges of one vocabulary file as sorted numpy arrays."""

    def __init__(self, vocab: str):
        with open(vocab, encoding="utf-8") as f:
            spec = json.load(f)
        model, ids = spec["model"], spec["model"]["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        marks = byte_symbols()
        self.inner = np.array([ids[m] for m in marks], np.int64)
        self.last = np.array([ids[m + suffix] for m in marks], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.result = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        if len(split) != 1 or set(self.steps) - {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"{vocab}: only word vocabularies with one split pattern are counted here")
        self.pattern = regex.compile(split[0])
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")

    def pretokens(self, piece: str) -> list[bytes]:
        if "NFC" in self.steps:
            piece = unicodedata.normalize("NFC", piece)
        if "Lowercase" in self.steps:  # letter by letter: a final sigma is no special case
            piece = piece.replace("Σ", "σ").lower()
        return [m.encode() for m in self.pattern.findall(piece)]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of the (non-empty) pre-tokens."""
        out = np.zeros(len(tokens), np.int64)
        sizes = np.array([len(t) for t in tokens], np.int64)
        start = 0
        while start < len(tokens):  # batches of about SYMBOLS symbols
            stop = max(start + 1, start + int(np.searchsorted(np.cumsum(sizes[start:start + SYMBOLS]), SYMBOLS, "right")))
            out[start:stop] = self._count(tokens[start:stop], sizes[start:stop])
            start = stop
        return out

    def _count(self, tokens: list[bytes], sizes: np.ndarray) -> np.ndarray:
        left_over = sizes.copy()
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbol = self.inner[flat]
        symbol[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        rank = np.full(len(symbol), _NONE)  # of the pair that starts at each place
        rank[:-1] = np.where(owner[:-1] == owner[1:], self.pair_ranks(symbol[:-1], symbol[1:]), _NONE)
        while len(symbol):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            width = np.diff(np.r_[first, len(owner)])
            lowest = np.minimum.reduceat(rank, first)
            going = np.repeat(lowest < _NONE, width)
            if not going.all():  # finished sequences leave
                symbol, owner, rank = symbol[going], owner[going], rank[going]
                lowest, width = lowest[lowest < _NONE], width[lowest < _NONE]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, width))
            fresh_run = np.r_[True, np.diff(at) != 1]  # in a run of overlapping pairs every second merges
            run_start = at[fresh_run][np.cumsum(fresh_run) - 1]
            at = at[(at - run_start) % 2 == 0]
            symbol[at] = self.result[rank[at]]
            np.subtract.at(left_over, owner[at], 1)
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # places after the merged ones close up
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            look = np.concatenate([moved, moved[moved > 0] - 1])
            after = np.minimum(look + 1, len(symbol) - 1)
            same = (after > look) & (owner[look] == owner[after])
            rank[look] = np.where(same, self.pair_ranks(symbol[look], symbol[after]), _NONE)
        return left_over


class Counter:
    """Token counts of texts; remembers up to ``limit`` short pieces."""

    def __init__(self, vocab: str, limit: int):
        self.table, self.limit = MergeTable(vocab), limit
        self.known: dict[str, int] = {}

    def _learn(self, pieces: list[str]) -> dict[str, int]:
        place: dict[bytes, int] = {}
        parts, extra = [], []
        for piece in pieces:
            texts, specials = [piece], 0
            if "<|" in piece:
                texts, specials = self.table.special.split(piece), len(self.table.special.findall(piece))
            parts.append([place.setdefault(t, len(place)) for x in texts for t in self.table.pretokens(x)])
            extra.append(specials)
        counts = self.table.count(list(place)).tolist() if place else []
        return {p: s + sum(counts[k] for k in own) for p, own, s in zip(pieces, parts, extra, strict=True)}

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [_WORDS.findall(x) if any(c in x for c in "\x1c\x1d\x1e\x1f") else x.split() for x in texts]
        missing: set[str] = set()
        for own in pieces:
            missing.update(own)
        missing.difference_update(self.known)
        new = self._learn(list(missing))
        if len(self.known) + len(new) <= self.limit:
            self.known.update((p, n) for p, n in new.items() if len(p) < 100)
            new = {p: n for p, n in new.items() if len(p) >= 100}
        if not new:
            return [sum(map(self.known.__getitem__, own)) for own in pieces]
        return [sum(new[p] if p in new else self.known[p] for p in own) for own in pieces]


@lru_cache(maxsize=2)
def counter(vocab: str, limit: int) -> Counter:
    return Counter(vocab, limit)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None,
                 limit: int = 2048, memo: int = MEMO_LIMIT) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids
    are counted row by row. Columns besides the two named ones are not read,
    so their names cannot clash.
    """
    vocab = vocab or vocabulary("word_bpe_49k.json")
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType(), False),
              T.StructField("n_tokens", T.LongType(), False), T.StructField("over_limit", T.BooleanType(), False)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocab, memo)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [x or "" for x in batch.column(1).to_pylist()]
                n = np.array(own.counts(texts), np.int64)
                size = np.array([len(x.encode()) for x in texts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, T.StructType(fields))
