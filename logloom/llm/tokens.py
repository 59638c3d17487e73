"""Encoding of whole texts with public tokenizers inside Spark tasks.

A text of plain Latin letters is cut at blanks, which no token of these vocabularies crosses, and a
bounded memo per Python worker keeps the ids that the tokenizers library gives for each distinct
cut.  Every other text goes to the library whole.  The result is always the library's own.
"""

from __future__ import annotations

import re
import struct
import zlib

#: Most entries of a worker's memo (about 200 bytes each); it starts anew when full.
MEMO_ENTRIES = 400_000
#: Anything beyond plain Latin letters, decimal digits, marks, blanks and line ends.
_NOT_LATIN = re.compile(r"[^\t\n\r\x20-\x7e¡-±´-¸º»¿-įı-ɏ–—‘-„…]")
#: A blank beside other white space: pretokens of byte-level vocabularies may then cross it.
_SPACE_RUN = re.compile(r"[ \t\r\n][ ]|[ ][\t\r\n]")
_WORDS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_BYTE_PIECES = re.compile(r" ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class _Memo(dict):
    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.learn(key)
        return value


class Encoder:
    """``ids(text)``: the library's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.name = name
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.words = self.tokenizer.normalizer is not None  # lower case, white space dropped
        self.specials = tuple(str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.pieces = _Memo(self._piece)
        self.cuts = _Memo(self._cut)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTE_LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _cut(self, cut: str) -> bytes:
        """The ids of one cut; for byte-level vocabularies, of a blank and the cut."""
        text = cut if self.words else " " + cut
        if "'" in cut:  # contractions join across letters
            return self.whole(text)
        return b"".join(map(self.pieces.__getitem__, (_WORDS if self.words else _BYTE_PIECES).findall(text)))

    def ids(self, text: str) -> bytes:
        if _NOT_LATIN.search(text) or "<|" in text:
            return self.whole(text)
        for memo in (self.cuts, self.pieces):
            if len(memo) > MEMO_ENTRIES:
                memo.clear()
        if self.words:
            return b"".join(map(self.cuts.__getitem__, text.lower().split()))
        if _SPACE_RUN.search(text) or text[:1] == " " or text[-1:] == " ":
            return self.whole(text)
        first, _, rest = text.partition(" ")
        return self.whole(first) + (b"".join(map(self.cuts.__getitem__, rest.split(" "))) if rest else b"")


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The worker's encoder of this vocabulary file."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def crc32(raw: bytes) -> int:
    return zlib.crc32(raw) & 0xFFFFFFFF
