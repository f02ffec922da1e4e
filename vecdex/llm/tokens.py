"""Encoding whole texts with the ``tokenizers`` library inside Spark tasks.

Both vocabularies split a text into pre-tokens that never cross the border
between a visible character and the white space after it. A text can
therefore be cut there, each piece encoded by the library once per worker,
and the ids of the pieces joined: the result is what the library returns for
the whole text, special strings included (they hold no white space). The
table of known pieces is bounded; once full, new pieces are encoded each time
they occur.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: characters with the Unicode White_Space property, as the vocabularies' patterns see them
WHITE = ("\t\n\x0b\x0c\r \x85\xa0"
         "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
#: white space other than the space and the line feed, and the controls Python also counts as space
_ODD = WHITE.replace(" ", "").replace("\n", "") + "\x1c\x1d\x1e\x1f"
_PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WORDS = re.compile(f"[^{WHITE}]+")
#: ASCII marks that end a run of letters without starting a contraction
_TAIL = ".,;:!?#$%&*|)"
#: pieces remembered per worker process, about 0.2 kB each
MEMO_LIMIT = 1_500_000


def _plain(core: str) -> bool:
    """Letters only, and still so after the vocabulary's normalisation."""
    return core.isalpha() and (core.isascii() or (
        core.lower().isalpha() and unicodedata.is_normalized("NFC", core)))


class _Memo(dict):
    """piece -> ids as little-endian unsigned 32-bit bytes, encoded on first use.

    ``lead`` stands before the piece when it is encoded; ``mark`` is how the
    model writes that lead in front of plain ASCII letters."""

    def __init__(self, tokenizer, lead: str, mark: str, lower: bool, limit: int):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.lead, self.mark, self.lower, self.limit = lead, mark, lower, limit
        self.tails: dict[str, bytes] = {}

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        core = piece.rstrip(_TAIL)
        if len(core) < len(piece) and _plain(core):
            tail = piece[len(core):]
            if tail not in self.tails:
                if len(self.tails) > 10_000:
                    self.tails.clear()
                self.tails[tail] = self.library(tail)
            ids = self[core] + self.tails[tail]
        elif core.isascii() and core.isalpha():
            word = core.lower() if self.lower else core
            ids = array("I", [t.id for t in self.model.tokenize(self.mark + word)]).tobytes()
        else:
            ids = self.library(self.lead + piece)
        if len(self) < self.limit and len(piece) < 100:
            self[piece] = ids
        return ids


class IdEncoder:
    """``encode(text)`` gives the ids of a text as little-endian u32 bytes."""

    def __init__(self, vocab: str, limit: int = MEMO_LIMIT):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(vocab)
        # the word vocabulary drops white space; the byte vocabulary keeps a
        # space as part of the following piece
        self.drops_space = not tokenizer.encode(" ", add_special_tokens=False).ids
        if self.drops_space:
            self.bare = _Memo(tokenizer, "", "", True, limit)
        else:
            self.bare = _Memo(tokenizer, "", "", False, limit // 4)
            self.spaced = _Memo(tokenizer, " ", "Ġ", False, limit)

    def encode(self, text: str) -> bytes:
        odd = any(c in text for c in _ODD)
        if self.drops_space:
            return b"".join(map(self.bare.__getitem__, _WORDS.findall(text) if odd else text.split()))
        if odd or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[-1:] == " ":
            return b"".join(map(self.bare.library, [text])) if len(text) < 200 else self._general(text)
        # white space runs are single characters here
        lines = text.split("\n")
        newline = self.bare["\n"]
        parts = []
        for line in lines:
            head, *rest = line.split(" ")
            parts.append((self.bare[head] if head else b"") + b"".join(map(self.spaced.__getitem__, rest)))
        return newline.join(parts)

    def _general(self, text: str) -> bytes:
        return b"".join(map(self.bare.library, _PIECES.findall(text)))


@lru_cache(maxsize=4)
def encoder(vocab: str, limit: int = MEMO_LIMIT) -> IdEncoder:
    """One encoder per worker process and vocabulary file."""
    return IdEncoder(vocab, limit)


def vocabulary(name: str) -> str:
    """Place of an installed vocabulary file; never copied into the repository."""
    import public_tokenizers
    return public_tokenizers.path(name)
