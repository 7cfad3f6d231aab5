"""Token ids of whole texts by a public tokenizer, with each distinct piece of text encoded once.

The two tokenizers used here never join text across certain gaps, so a text's ids are those of its
pieces in order:

- ``word`` (white space is dropped, words end at it): any space or line break is a gap;
- ``byte`` (a space belongs to the word behind it): a single space or line break between two other
  characters is a gap, and the space stays in front of its piece. A text with white space beside
  white space (or at its ends) is cut only at gaps of this kind, by a pattern.

Pieces are encoded by the library and kept in two generations of at most ``KEPT`` each, so memory
stays bounded while frequent pieces stay known. A piece of plain Latin letters is one word to either
tokenizer and its ids come from the library's BPE model alone; the marks behind such letters, up to the
piece's end, are a word of their own. All other pieces take the library's whole way, and so does the
whole of a text that holds the name of a special token, unless such names are to be ordinary text.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from functools import cache

import numpy as np

KEPT = 300_000
_LONGEST_KEPT = 24
_MARKS = string.punctuation
_GAP = re.compile(r"(?<=\S)(?=[ \n]\S)")


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Unsafe(Exception):
    pass


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: a printable byte for itself,
    the others for the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Pieces(dict):
    """Piece -> its ids as little-endian 32-bit integers."""

    def __init__(self, encode, strict: bool):
        super().__init__()
        self.encode, self.strict, self.old = encode, strict, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if self.strict and (not piece or piece[0].isspace() or piece[-1].isspace()):
                raise _Unsafe
            ids = self.encode(piece, self)
        if len(piece) <= _LONGEST_KEPT:
            if len(self) >= KEPT:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """``encode`` gives the ids of a whole text as unsigned 32-bit integers.

    They are those of the library's ``encode`` without added tokens: the name of a special token in a text
    is that token. With ``names_as_text`` it is encoded like other text.
    """

    def __init__(self, path: str, names_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)  # once: a vocabulary takes 30 MB of each worker
        tokenizer.encode_special_tokens = True  # a piece holds no name as the text had it
        added = tokenizer.get_added_tokens_decoder().values()
        self._names = [] if names_as_text else [token.content for token in added]

        model, letters, lower = tokenizer.model, _byte_letters(), tokenizer.normalizer is not None
        spelled = {chr(c): "".join(letters[b] for b in chr(c).encode()) for c in range(256)}
        space = letters[ord(" ")]

        def whole(text: str) -> bytes:
            found = tokenizer.encode(text, add_special_tokens=False).ids
            return np.asarray(found, "<u4").tobytes()

        def word(text: str, front: str) -> bytes:
            if lower:
                text = text.lower()
            if not text.isascii():
                text = "".join(map(spelled.__getitem__, text))
            return array("I", [t.id for t in model.tokenize(front + text)]).tobytes()

        def with_names(text: str) -> np.ndarray:
            tokenizer.encode_special_tokens = False
            try:
                return np.frombuffer(whole(text), "<u4")
            finally:
                tokenizer.encode_special_tokens = True

        def ids(piece: str, known: _Pieces, front: str = "") -> bytes:
            body = piece.rstrip(_MARKS)
            if body.isalpha() and (body.isascii() or max(body) <= "\xff"):
                if len(body) == len(piece):
                    return word(piece, front and space)
                return known[body] + marks[piece[len(body) :]]  # often the word is known without its marks
            return whole(front + piece)

        marks = _Pieces(lambda piece, _: whole(piece), strict=False)
        self._with_names = with_names
        self._drops_space = lower
        self._vocabulary = tokenizer.get_vocab_size()
        self._plain = _Pieces(ids, strict=False)
        self._inner = _Pieces(lambda piece, known: ids(piece, known, " "), strict=True)
        self._first = _Pieces(ids, strict=True)
        self._broken = _Pieces(ids, strict=False)

    @property
    def bits(self) -> int:
        """Least bits that hold every id of the vocabulary."""
        return max(1, (self._vocabulary - 1).bit_length())

    def encode(self, text: str) -> np.ndarray:
        if any(name in text for name in self._names):
            return self._with_names(text)
        if self._drops_space:
            if _latin(text):  # lower-casing each letter commutes with the other steps here
                text = text.lower()
            pieces = text.replace("\n", " ").split(" ")
            return np.frombuffer(b"".join(map(self._plain.__getitem__, pieces)), "<u4")
        return np.frombuffer(self._spaced(text), "<u4")

    def _spaced(self, text: str) -> bytes:
        if not text:
            return b""
        known, first, broken = self._inner, self._first, self._broken
        out = []
        try:
            for number, line in enumerate(text.split("\n")):
                pieces = line.split(" ")
                if number:
                    out.append(broken["\n"])
                out.append(first[pieces[0]])
                out.extend(map(known.__getitem__, pieces[1:]))
            return b"".join(out)
        except _Unsafe:
            return b"".join(map(broken.__getitem__, _GAP.split(text)))


@cache
def encoder(path: str, names_as_text: bool = False) -> Encoder:
    """One per worker process."""
    return Encoder(path, names_as_text)
