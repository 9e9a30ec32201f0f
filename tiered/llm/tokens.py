"""Token ids of whole texts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import public_tokenizers

#: Any two adjacent white-space characters.
_ADJACENT = re.compile(r"\s\s")


#: Characters below this one have been letters or not for as long as tables of them exist.
_SETTLED = "\u0250"
#: Signs that never join a letter before them; an apostrophe may begin a token with letters.
_STOPS = ".,;:!?\"#$%&()*+-/<=>@[\\]^_`{|}~"
#: Byte-level alphabets write each byte as a printable character: itself where it has one,
#: else the next free character from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: b for b in _PRINTABLE} | {
    b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))
}
_SPACE = chr(_ALPHABET[0x20])


#: Pieces that an encoder remembers unless told otherwise.
REMEMBER = 800_000


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to encoding whole texts.

    A single space between two characters that are not white space always begins a token,
    and a single line feed between two such is a token of its own, so texts without adjacent
    white space are cut there, and each distinct piece is encoded once while it is
    remembered; this is the table of pieces. Other texts,
    and texts with a special token's string, go to the library whole. About `remember`
    pieces are kept, so memory does not grow with the corpus.
    """

    def __init__(self, path: str, remember: int = REMEMBER) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Words that come again are in this table; the model's own one would only be filled.
        self.model._resize_cache(0)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remember = remember

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        word = piece.removeprefix(" ")
        if word.isalpha() and (word.isascii() or max(word) < _SETTLED):
            # One word, with its space or without: the model takes it as it is.
            if word.isascii():
                plain = piece.replace(" ", _SPACE)
            else:
                plain = piece.encode().decode("latin-1").translate(_ALPHABET)
            ids = array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()
        elif (stem := word.rstrip(_STOPS)) != word and stem.isalpha() and max(stem) < _SETTLED:
            # A run of signs after a word is a token run of its own.
            at = len(piece) - len(word) + len(stem)
            ids = self[piece[:at]] + self[piece[at:]]
        else:
            ids = self.whole(piece)
        self[piece] = ids
        return ids

    def cut(self, text: str) -> list[str] | None:
        if "\x00" in text or _ADJACENT.search(text) or any(s in text for s in self.special):
            return None
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; a null text has none."""
        out = []
        for text in texts:
            pieces = self.cut(text) if text else None
            if len(self) > self.remember:
                self.clear()
            if pieces is None:
                out.append(self.whole(text) if text else b"")
            else:
                out.append(b"".join(map(self.__getitem__, pieces)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, remember: int = REMEMBER) -> Encoder:
    """One encoder a worker process: what it remembers serves later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].remember = remember
    return _ENCODERS[path]


def slices(texts: list[str | None], chars: int = 1 << 20) -> Iterator[range]:
    """Row ranges of about `chars` characters; a longer text is a range of its own."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= chars or k == len(texts) - 1:
            yield range(first, k + 1)
            first, size = k + 1, 0


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
