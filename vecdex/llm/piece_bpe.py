"""SentencePiece encoding and decoding by vectorised merge rounds.

The distinct words of a batch lie in one flat numpy array of symbols. In each
round every word finds the lowest rank among its adjacent pairs (a segmented
minimum) and merges all places where a pair of that rank stands, leftmost first,
at once; the array is compacted and words without a mergeable pair leave it.

A model's merge order is "best score, then leftmost". Merging several places of
a word at once keeps that order unless a merge makes a pair of the same or a
better rank beside it, which a later place could lose a symbol to. Every round
looks for such pairs; words that have one are merged one pair at a time instead.

Texts are cut into words where no piece of the vocabulary can lie across the
cut: before the white space mark that follows another character, around line
feeds, and, in words of more than ``LONG`` characters, between any two
characters that no piece holds side by side. Pieces, scores and byte pieces are
read from the model file. Ids of frequent words are remembered per worker, up to
a bound.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
_NONE = np.int64(1) << 40
#: symbols merged together; a longer word makes a batch of its own
SYMBOLS = 1 << 20
#: longer words are looked through for further cuts, and are not remembered
LONG = 64
#: words remembered per worker process, about 0.2 kB each
MEMO_LIMIT = 400_000
#: texts encoded together; also the rows of a batch that goes back to Spark
BATCH_ROWS = 256
#: symbols from here on stand for a character (offset by this) that is no piece
_CHAR = 1 << 24
_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class PieceModel:
    """One BPE model with byte fallback, identity normalisation and a leading
    white space mark; other kinds are refused."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        pieces = {sp.id_to_piece(i): i for i in every
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        bytes_of = {int(sp.id_to_piece(i)[3:5], 16): i for i in every if sp.is_byte(i)}
        probe = "  AＡﬁ  b "
        if len(bytes_of) != 256 or any(map(sp.is_unused, every)) or sp.decode(sp.encode(probe)) != probe:
            raise ValueError(f"{path}: not a model with byte fallback and identity normalisation")
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in pieces):
            raise ValueError(f"{path}: pieces lie across words or lines")
        self.byte_id = np.array([bytes_of[b] for b in range(256)], np.int64)
        surface = [b"" if sp.is_control(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in every]
        for b, i in bytes_of.items():
            surface[i] = bytes([b])
        for i in every:
            if sp.is_unknown(i):
                surface[i] = sp.decode([i]).encode()
        self.surface = surface
        self.is_byte = np.zeros(len(every), bool)
        self.is_byte[self.byte_id] = True
        self.leading = np.array([sp.id_to_piece(i).startswith(MARK) for i in every])
        self.silent = np.array([sp.is_control(i) for i in every])
        # characters of pieces that are no pieces themselves still merge
        symbols = dict(pieces)
        for c in {c for p in pieces for c in p}:
            symbols.setdefault(c, _CHAR + ord(c))
        score = {p: sp.get_score(i) for p, i in pieces.items()}
        place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        rows = [(symbols[p[:k]], symbols[p[k:]], place[score[p]], symbols[p])
                for p in pieces for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        table = np.array(rows, np.int64).reshape(-1, 4)
        keys = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.results = keys[order], table[order, 2], table[order, 3]
        self.char = np.arange(0x110000, dtype=np.int64) + _CHAR
        for p, i in pieces.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.beside = np.unique(np.array([ord(a) << 32 | ord(b) for p in pieces for a, b in zip(p, p[1:])], np.int64))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair of symbols."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.results[at]

    def words(self, text: str) -> list[str]:
        """The words of a text, white space as marks."""
        if not text:
            return []
        found = _WORD.findall(MARK + text.replace(" ", MARK))
        if max(map(len, found)) > LONG:
            found = [part for word in found for part in (self._cut(word) if len(word) > LONG else (word,))]
        return found

    def _cut(self, word: str) -> list[str]:
        code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        key = code[:-1] << 32 | code[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        ends = [0, *(np.flatnonzero(self.beside[at] != key) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(ends, ends[1:])]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each (non-empty) word, as little-endian u32 bytes."""
        out: list[bytes] = []
        sizes = np.array([len(w) for w in words], np.int64)
        start = 0
        while start < len(words):  # batches of about SYMBOLS symbols
            stop = max(start + 1, start + int(np.searchsorted(np.cumsum(sizes[start:start + SYMBOLS]), SYMBOLS, "right")))
            out += self._encode(words[start:stop], sizes[start:stop])
            start = stop
        return out

    def _encode(self, words: list[str], sizes: np.ndarray) -> list[bytes]:
        symbol = self.char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        first_symbols = symbol.copy()
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(words)), sizes)
        done_owner, done_symbol, ordered = [], [], []
        rank, result = np.full(len(symbol), _NONE), np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:  # of the pair that starts at each place
            rank[:-1], result[:-1] = self.pairs(symbol[:-1], symbol[1:])
            rank[:-1][owner[:-1] != owner[1:]] = _NONE
        while len(symbol):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            width = np.diff(np.r_[first, len(owner)])
            lowest = np.minimum.reduceat(rank, first)
            going = np.repeat(lowest < _NONE, width)
            if not going.all():  # finished words leave
                done_owner.append(owner[~going]), done_symbol.append(symbol[~going])
                symbol, owner, rank, result = symbol[going], owner[going], rank[going], result[going]
                width, lowest = width[lowest < _NONE], lowest[lowest < _NONE]
                if not len(symbol):
                    break
            low = np.repeat(lowest, width)
            at = np.flatnonzero(rank == low)
            fresh_run = np.r_[True, np.diff(at) != 1]  # in a run of overlapping pairs every second merges
            at = at[(at - at[fresh_run][np.cumsum(fresh_run) - 1]) % 2 == 0]
            # the next place's left symbol, as the first of two adjacent merges sees it
            near = at[:-1][(np.diff(at) == 2) & (owner[at[:-1]] == owner[at[1:]])]
            early = near[self.pairs(result[near], symbol[near + 2])[0] <= low[near]]
            many = np.bincount(owner[at], minlength=len(words))
            mixed = set(owner[early].tolist())
            symbol[at] = result[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # places after the merged ones close up
            symbol, owner, rank, result, low = symbol[keep], owner[keep], rank[keep], result[keep], low[keep]
            look = np.concatenate([moved, moved[moved > 0] - 1])
            after = np.minimum(look + 1, len(symbol) - 1)
            same = (after > look) & (owner[look] == owner[after])
            fresh_rank, result[look] = self.pairs(symbol[look], symbol[after])
            rank[look] = np.where(same, fresh_rank, _NONE)
            mixed.update(owner[look[(rank[look] <= low[look]) & (many[owner[look]] > 1)]].tolist())
            if mixed:  # the order of these words' merges matters: one at a time, from the start
                ordered += mixed
                keep = ~np.isin(owner, list(mixed))
                symbol, owner, rank, result = symbol[keep], owner[keep], rank[keep], result[keep]
        for k in ordered:
            own = self._one_by_one(first_symbols[starts[k]:starts[k] + sizes[k]])
            done_owner.append(np.full(len(own), k)), done_symbol.append(own)
        owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
        order = np.argsort(owner, kind="stable")
        ids, ends = self._with_bytes(owner[order], symbol[order], len(words))
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _with_bytes(self, owner: np.ndarray, symbol: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, characters without a piece as their bytes, and where words end."""
        odd = np.flatnonzero(symbol >= _CHAR)
        if len(odd):
            spelt = [chr(c).encode() for c in (symbol[odd] - _CHAR).tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(s) for s in spelt]
            owner, place = np.repeat(owner, times), np.repeat(symbol >= _CHAR, times)
            symbol = np.repeat(symbol, times)
            symbol[place] = self.byte_id[np.frombuffer(b"".join(spelt), np.uint8)]
        return symbol.astype("<u4"), np.cumsum(np.bincount(owner, minlength=n))

    def _one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """A single word's merges in the model's order, one pair at a time."""
        ranks, results = self.pairs(symbols[:-1], symbols[1:])
        symbol = symbols.tolist()
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        heap = [(r, k, symbol[k], symbol[k + 1], z) for k, (r, z) in enumerate(zip(ranks.tolist(), results.tolist())) if r < _NONE]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, z = heapq.heappop(heap)
            other = after[k]
            if symbol[k] != a or other >= len(symbol) or symbol[other] != b:
                continue  # one of the two is part of another symbol by now
            symbol[k], symbol[other] = z, None
            after[k] = after[other]
            if after[k] < len(symbol):
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < len(symbol):
                    (r,), (z,) = self.pairs(np.array([symbol[x]]), np.array([symbol[y]]))
                    if r < _NONE:
                        heapq.heappush(heap, (int(r), x, symbol[x], symbol[y], int(z)))
        return np.array([s for s in symbol if s is not None], np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids: marks are spaces, the first one of the text
        goes, byte pieces make characters, and bytes that make none are U+FFFD."""
        shown = ids[~self.silent[ids]]
        raw = b"".join(map(self.surface.__getitem__, shown.tolist()))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(shown)
        return text[1:] if len(shown) and self.leading[shown[0]] else text

    def _decode_broken(self, ids: np.ndarray) -> str:
        out = []
        cuts = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for run in np.split(ids, cuts):
            raw = b"".join(map(self.surface.__getitem__, run.tolist()))
            while raw:
                try:
                    out.append(raw.decode())
                    raw = b""
                except UnicodeDecodeError as bad:
                    out.append(raw[:bad.start].decode() + "�")
                    raw = raw[bad.start + 1:]
        return "".join(out)


class Encoder:
    """Ids of texts as little-endian u32 bytes; remembers up to ``limit`` short words."""

    def __init__(self, path: str, limit: int):
        self.model, self.limit = PieceModel(path), limit
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [self.model.words(t) for t in texts]
        missing: set[str] = set()
        for own in words:
            missing.update(own)
        missing.difference_update(self.known)
        fresh = list(missing)
        new = dict(zip(fresh, self.model.encode_words(fresh)))
        if len(self.known) + len(new) <= self.limit:
            self.known.update((w, i) for w, i in new.items() if len(w) <= LONG)
            new = {w: i for w, i in new.items() if len(w) > LONG}
        if not new:
            return [b"".join(map(self.known.__getitem__, own)) for own in words]
        return [b"".join([new[w] if w in new else self.known[w] for w in own]) for own in words]


@lru_cache(maxsize=2)
def encoder(path: str, limit: int) -> Encoder:
    return Encoder(path, limit)


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO_LIMIT) -> DataFrame:
    """``id_col, ids`` (array of int) for every row of ``docs``: what the library's
    ``encode`` gives with the model file, without begin and end ids.

    A null or empty text has no ids. Repeated rows and null ids are encoded row by
    row; an empty table gives an empty result. Columns besides the two named ones
    are not read, so their names cannot clash."""
    return _encoded(docs, model, id_col, text_col, memo, None)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO_LIMIT,
               out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``, the text that ``decoded`` gives for the ids, in one
    pass: ids are decoded where they were made, and travel once."""
    return _encoded(docs, model, id_col, text_col, memo, out_col)


def _encoded(docs: DataFrame, model: str, id_col: str, text_col: str, memo: int, out_col: str | None) -> DataFrame:
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           *([T.StructField(out_col, T.StringType())] if out_col else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model, memo)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                ids = own.encode([x or "" for x in batch.column(1).to_pylist()])
                ends = np.cumsum([0, *[len(b) // 4 for b in ids]], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                texts = [pa.array(_texts(lists, own.model), pa.string())] if out_col else []
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, *texts], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _texts(lists: pa.ListArray, model: PieceModel) -> list[str]:
    """The text of each list of ids; a null list has none."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = [n or 0 for n in lists.value_lengths().to_pylist()]
    ends = np.cumsum([0, *sizes]).tolist()
    return [model.decode(flat[a:b]) for a, b in zip(ends, ends[1:])]


def decoded(frame: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``frame`` with ``out_col``, the text of the ids in ``ids_col`` as the library's
    ``decode`` gives it; null and empty lists give an empty text. A column named
    like ``out_col`` is replaced."""
    frame = frame.drop(out_col)
    at = frame.columns.index(ids_col)
    schema = T.StructType([*frame.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model, 0).model
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_texts(batch.column(at), own), pa.string())], schema.names)

    return frame.mapInArrow(run, schema)
