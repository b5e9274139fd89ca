"""Cached pieces of public tokenizers, used inside Python workers.

A tokenizer's pre-tokens never reach across white space, so what a word becomes does not depend on
its neighbours. Texts repeat most of their words: the library sees a word once per worker, and
texts are put together from what it said. Words with anything beyond ASCII and Latin-1 letters go
to the library as they are, which keeps results equal to it. A text without such words is cut to
pre-tokens in one go.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: Entries of one of the two halves of a worker's cache.
CACHE_WORDS = 300_000
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: Fixed: how the lower-case word vocabulary splits a word.
_WORD_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\t-\r ]+")
#: Fixed: how the byte-level vocabulary splits a text.
_BYTE_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+|"
                         r" ?[^\s0-9A-Za-zÀ-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")
_BYTE_TEXT = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_SPECIAL = "<|"


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _printable() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: printable bytes stand for
    themselves, the others for code points from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_BYTE_CHARS = {b: c for b, c in enumerate(_printable())}


def written_in_bytes(part: str) -> str:
    return part.encode().decode("latin-1").translate(_BYTE_CHARS)


class Cache(dict):
    """What a function gave for a key. When it is full, what was not asked for since it was last full
    goes. Keys of more than 64 characters are not kept."""

    def __init__(self, function):
        self.function, self.old = function, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.function(key)
        if len(key) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class WordIds:
    """Ids of a text, its words (bytes, no ASCII white space) and their parts, as little-endian
    unsigned 32-bit words."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.words, self.parts = Cache(self._word), Cache(self._part)

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return b"".join(map(self.parts.__getitem__, _WORD_PARTS.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(written_in_bytes(part))])

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        if _SPECIAL not in text and _PLAIN_TEXT.fullmatch(text):
            return b"".join(map(self.parts.__getitem__, _WORD_PARTS.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, text.encode("utf-8", "replace").split()))


def byte_parts(text: str, tokenizer) -> list[str]:
    """The pre-tokens of a text, as the byte-level tokenizer cuts them; a special token's string is
    one of its own, since the library finds those first."""
    if _SPECIAL not in text:
        if text.isascii() or _BYTE_TEXT.fullmatch(text):
            return _BYTE_PARTS.findall(text)
        return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    out, special = [], "|".join(map(re.escape, special_strings(tokenizer)))
    for piece in re.split(f"({special})", text):
        if piece in special_strings(tokenizer):
            out.append(piece)
        elif piece:
            out.extend(byte_parts(piece, tokenizer) if _SPECIAL not in piece else
                       [piece[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(piece)])
    return out


def special_strings(tokenizer) -> set[str]:
    return {t.content for t in tokenizer.get_added_tokens_decoder().values()}


def count_pieces(part: str, tokenizer, special: set[str]) -> int:
    if part in special:
        return 1
    return len(tokenizer.model.tokenize(written_in_bytes(part)))
