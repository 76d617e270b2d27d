"""Token ids of whole texts as bytes, with the ids of repeated pieces remembered.

Texts are cut where no token can reach across, into pieces and these into words. A word that came before
is looked up; for a new one the library's model applies its merges. The results equal those of encoding
each text at once. Where a cut could differ from the library's own, the library gets the whole: a text
with white space other than ASCII's or with the string of an added token, a piece with letters beyond Latin-1.
"""

from __future__ import annotations

import re
import struct
import sys
from collections.abc import Callable
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import regex

#: Pieces and words a Python worker remembers, about 200 bytes each; only speed depends on it.
REMEMBERED = 1_000_000

#: White space or controls that tokenizers treat in ways of their own.
UNUSUAL = re.compile("[\x00-\x08\x0e-\x1f\x7f\x85\xa0 ᠎ -‏    ⁠　﻿]")


@dataclass(frozen=True)
class Scheme:
    """How a vocabulary cuts texts: into pieces at ASCII white space, these into words; all in lower case or not."""

    pieces: Callable[[str], list[str]]
    words: regex.Pattern
    lower: bool


#: Words with the one space before them; runs of space without their last character; other space.
SPACED = re.compile(r" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]")

#: Where a text holds one of these, SPACED cuts it; elsewhere each space and line end stands alone.
RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")


def spaced_pieces(text: str) -> list[str]:
    """What SPACED finds in a text without unusual characters, by plain cuts where white space is single."""
    if any(run in text for run in RUNS):
        return SPACED.findall(text)
    return text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01").split("\x01")


BYTES = Scheme(
    spaced_pieces,
    regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"),
    lower=False,
)

#: Words alone, numbers by digit; white space is no part of any token.
WORDS = Scheme(
    str.split,
    regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"),
    lower=True,
)


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def vocabulary(name: str) -> str:
    """The place of one of the public vocabularies installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """Pieces and their ids. Those not used for a while are forgotten, so the size is bounded."""

    def __init__(self, ask: Callable[[str], bytes], most: int):
        super().__init__()
        self.ask, self.half, self.older = ask, most // 2, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.ask(piece)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without any id added."""

    def __init__(self, path: str, scheme: Scheme, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [re.escape(token.content) for token in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or r"(?!)", re.IGNORECASE)  # a vocabulary may look for them in lower case
        self.merge, self.letters = self.library.model.tokenize, _byte_letters()
        self.pieces, self.split, self.lower = scheme.pieces, scheme.words.findall, scheme.lower
        self.known = _Known(self._piece, remembered)

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.merge(word.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii() and max(piece) > "\xff":
            return self.whole(piece)
        if self.lower:
            piece = piece.lower()
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
            return self._word(piece)
        words = self.split(piece)
        return self._word(words[0]) if len(words) == 1 else b"".join([self.known[w] for w in words])

    def whole(self, text: str) -> bytes:
        """The ids that the library gives for the text at once."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if UNUSUAL.search(text) or self.added.search(text):
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, self.pieces(text)))


def encoder(path: str, scheme: Scheme) -> Encoder:
    """The encoder of this Python worker, kept between its tasks."""
    kept = sys.modules.setdefault("cohortrates_worker_state", ModuleType("cohortrates_worker_state"))
    made = kept.__dict__.setdefault("encoders", {})
    if path not in made:
        made[path] = Encoder(path, scheme)
    return made[path]
