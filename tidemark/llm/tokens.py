"""Token ids of whole texts, with each distinct piece of text encoded once per worker.

The library's pre-tokenizers never join text across certain places, so a text's ids are those of its pieces in a row.
`word` vocabularies (white space dropped) break at ASCII white space. `byte` vocabularies break before a word's leading
space and around runs of white space. An unknown piece that is one word (letters that normalization leaves
alone, perhaps with signs behind, which are a piece of their own) goes to the library's model; all others go
through the whole library.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache, partial

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Unicode's White_Space, written out: Python's `\s` has four more.
_WS = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_BYTE_PIECES = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
_ANY_WS = re.compile(f"[{_WS}]")
#: Pieces a worker remembers (about 200 bytes each), and the longest one worth remembering.
CACHE_PIECES, CACHE_LENGTH = 450_000, 64
#: Letters below this code are letters in every Unicode version that a library may follow.
_OLD_LETTERS = "\u0530"
#: Below this code nothing combines with what stands before it, so lower-casing and normalization don't depend on their order.
_FIRST_MARK = "\u0300"
#: What may stand behind a word as one piece of its own: ASCII signs, but for the apostrophe, which may join.
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def path(name: str) -> str:
    """Where a public vocabulary file lies on this machine (files are installed on every node)."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """Ids by piece; an unknown piece is learned when it is asked for."""

    def __init__(self, learn: Callable[[bytes, dict], bytes | None]):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: bytes) -> bytes | None:
        ids = self.learn(piece, self)
        if len(piece) <= CACHE_LENGTH:
            self[piece] = ids
        return ids

    def forget(self) -> None:
        """When there are too many, the later half goes: the commonest pieces came first."""
        if len(self) > CACHE_PIECES:
            for k in list(self)[CACHE_PIECES // 2 :]:
                del self[k]


class Pieces:
    """Ids of pieces of one vocabulary, as its library gives them."""

    def __init__(self, file: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.kind = kind
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.tokenize = self.tokenizer.model.tokenize
        self.packed = [np.array([i], self.dtype).tobytes() for i in range(size)]
        # the byte alphabet of byte-level vocabularies: printable Latin-1 stands for itself, other bytes are numbered from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.alphabet = {b: chr(b if b in shown else next(other)) for b in range(256)}
        #: By piece; `spaced`: pieces after one space, without it; `signs`: runs of signs behind words. `None` marks what only the slow path can read.
        self.plain, self.spaced = (_Known(partial(self.piece, front)) for front in ("", self.alphabet[32]))
        self.signs = _Known(lambda piece, _: self.library([piece.decode()])[0])
        self.line_feed = self.library(["\n"])[0] if kind == "byte" else b""

    def library(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as the library gives them."""
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word_of(self, base: bytes) -> bytes | None:
        """The word that the library's normalization makes of this one, if it is one word and that is sure."""
        if base.isalpha():
            return base.lower() if self.kind == "word" else base
        text = base.decode("utf-8", "replace")
        if not text.isalpha() or max(text) >= _OLD_LETTERS:
            return None
        if self.kind == "byte":
            return base
        low = text.lower()  # the library lower-cases letter by letter, after normalization
        if low != text and (max(text) >= _FIRST_MARK or len(low) != len(text)) or not unicodedata.is_normalized("NFC", text):
            return None
        return low.encode()

    def piece(self, front: str, piece: bytes, known: dict[bytes, bytes | None]) -> bytes | None:
        """Ids of a piece, after a space if `front` stands for one."""
        base = piece if piece.isalpha() else piece.rstrip(_SIGNS)
        word = self.word_of(base)
        if word is None:
            text = piece.decode("utf-8", "replace")
            if self.kind == "byte" and (not piece or _ANY_WS.search(text)):
                return None
            return self.library([(" " if front else "") + text])[0]
        if (ids := known.get(word)) is None:
            letters = word.decode() if word.isascii() else word.decode("latin-1").translate(self.alphabet)
            packed = self.packed
            ids = b"".join([packed[x.id] for x in self.tokenize(front + letters)])
        return ids if len(base) == len(piece) else ids + self.signs[piece[len(base) :]]

    def _joined(self, text: bytes) -> bytes:
        """A text's ids from its pieces; TypeError for what the slow path must read."""
        if self.kind == "word":
            return b"".join(map(self.plain.__getitem__, text.split()))
        plain, spaced = self.plain.__getitem__, self.spaced.__getitem__
        lines = []
        for line in text.split(b"\n"):
            first, *more = line.split(b" ")
            lines.append(b"".join([plain(first), *map(spaced, more)]))
        return self.line_feed.join(lines)

    def _whole(self, text: bytes) -> bytes:
        if self.kind == "byte" and any(s in text for s in self.special):
            return self.library([text.decode("utf-8", "replace")])[0]
        try:
            return self._joined(text)
        except TypeError:
            return b"".join(self.library(_BYTE_PIECES.findall(text.decode("utf-8", "replace"))))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed little-endian ids of each whole text."""
        collects = gc.isenabled()
        gc.disable()  # pieces make no cycles
        try:
            return [self._whole(t) if t else b"" for t in texts]
        finally:
            for known in (self.plain, self.spaced, self.signs):
                known.forget()
            if collects:
                gc.enable()


@lru_cache(maxsize=1)
def pieces_of(file: str, kind: str) -> Pieces:
    """This worker's pieces of one vocabulary."""
    return Pieces(file, kind)
