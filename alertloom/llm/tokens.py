"""Ids of public tokenizers for whole texts, with the merges of the tokenizers library.

A text is cut at places where the tokenizer's own pattern always cuts, whatever stands around them; the ids of a piece are then
the same alone as in its text, and are kept in a bounded table of two generations: what is used while the young one fills
is young again, so frequent pieces stay however many rare ones pass. Pieces that are Latin-1 words with at most one
punctuation mark, nearly all, go straight to the model's merges; any other piece goes through the whole tokenizer.
"""

from __future__ import annotations

import re
import sys
from array import array

from alertloom.llm.shared import once

#: Entries of one generation of a table of pieces, of some 200 bytes each.
PIECES = 600_000
WORD = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?|]?)")
#: White space other than the blank and the line feed, and two of these in a row.
RARE_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"] + ["  ", "\n ", " \n", "\n\n"]
BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable bytes for themselves, the others from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


BYTE_CHARS = byte_chars()


def as_chars(text: str) -> str:
    """A text as byte characters."""
    return "".join([BYTE_CHARS[b] for b in text.encode()])


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)  # of 4 bytes
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Pieces(dict):
    """Ids, as little-endian unsigned 32-bit integers, of pieces. This is the young generation; when it is full it becomes the old one,
    and what of the old one is asked for again moves to the young one."""

    def __init__(self, encode, generation: int):
        super().__init__()
        self.encode, self.generation, self.old = encode, generation, {}

    def __missing__(self, piece):
        ids = self.old.get(piece)
        if ids is None:
            ids = packed(self.encode(piece))
        if len(self) >= self.generation:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer, generation: int | None = None):
        tokenizer.encode_special_tokens = True
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.pieces = Pieces(self.piece, generation or PIECES)
        self.marks = {"": []}

    def piece(self, piece) -> list[int]:
        raise NotImplementedError

    def whole(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def merged(self, chars: str) -> list[int]:
        return [t.id for t in self.model.tokenize(chars)]

    def mark(self, mark: str) -> list[int]:
        """The ids of a punctuation mark or the line feed, which are few."""
        ids = self.marks.get(mark)
        if ids is None:
            ids = self.marks[mark] = self.merged(as_chars(mark))
        return ids


class WordEncoder(Encoder):
    """For tokenizers that drop white space and fold case: pieces are what stands between ASCII white space."""

    def piece(self, piece: bytes) -> list[int]:
        text = piece.decode()
        if piece.isalpha():  # in ASCII
            return self.merged(text.lower())
        m = WORD.fullmatch(text)
        if not m:
            return self.whole(text)
        word = m[1].lower()
        return self.merged(word if word.isascii() else as_chars(word)) + self.mark(m[2])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.pieces.__getitem__, t.encode().split())) for t in texts]


class ByteEncoder(Encoder):
    """For byte-level tokenizers, in which a blank belongs to the word after it: a piece begins at a blank after
    another character than white space, and at a line feed between two such characters."""

    def piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isalpha():
            return self.merged(BYTE_CHARS[32] + piece)
        line = piece[:1] == "\n"
        m = WORD.fullmatch(piece, line)
        if not m:
            return self.whole(piece if line else " " + piece)
        word = m[1] if m[1].isascii() else as_chars(m[1])
        return (self.mark("\n") + self.merged(word) if line else self.merged(BYTE_CHARS[32] + word)) + self.mark(m[2])

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if any(x in text for x in RARE_SPACE):
                first, *rest = BEFORE_BLANK.split(text)
                ids = [packed(self.whole(p)) if p[1:2] == "\n" else self.pieces[p[1:]] for p in rest]
            else:
                first, *rest = text.replace("\n", " \n").split(" ")
                ids = map(self.pieces.__getitem__, rest)
            out.append(packed(self.whole(first)) + b"".join(ids))
        return out


def from_file(path: str, words: bool) -> Encoder:
    """The encoder of a tokenizer's file, read once in a Python process."""
    def make() -> Encoder:
        from tokenizers import Tokenizer

        return (WordEncoder if words else ByteEncoder)(Tokenizer.from_file(path))

    return once(f"encoder of {path}", make)


def public_path(name: str) -> str:
    """The place of a public vocabulary on the machine that asks; called in tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)
