"""Token ids of whole texts by a public tokenizer, word by word with a bounded cache.

A tokenizer of the kinds used here splits a text into pieces that never reach across a
word's white space, and encodes each piece on its own.  So a text's ids are the ids of
its space-bounded chunks in turn.  Chunks that a task has not met yet go through the
library's model; the others come from a dictionary.  That
is several times faster than encoding whole texts, with the same ids (tests compare).
"""

from __future__ import annotations

import re
import struct
import sys
from collections.abc import Callable, Iterable
from operator import attrgetter
from types import ModuleType
from unicodedata import is_normalized

# White space as the tokenizers' patterns see it is the Unicode property; Python's \s adds
# four control characters, which are left out for the texts that have them (fixed values).
_ODD = "\x1c\x1d\x1e\x1f"
_WORD, _GAP = f"(?:\\S|[{_ODD}])", f"(?:(?![{_ODD}])\\s)"
#: White space other than single spaces and line ends.
_RARE = ("  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))
#: How a text is cut into chunks, and one that has the odd control characters; then whether
#: a chunk takes the space before its word.
#: Byte-level tokenizers: it does; of a longer run of white space the last character is left
#: to what follows.
SPACED = (re.compile(r" ?\S+|\s+(?!\S)|\s+").findall,
          re.compile(f" ?{_WORD}+|{_GAP}+(?!{_WORD})|{_GAP}+").findall, True)
#: Tokenizers that drop white space.
BARE = (str.split, re.compile(f"{_WORD}+").findall, False)
#: Marks that are no part of the word they follow: up to ``TAIL`` of them are pieces of their own.
_MARKS = ".,;:!?|#*$%&<>"
TAIL = 3
#: Chunks that an encoder holds.
CACHE = 1_000_000


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write each byte as a letter: printable bytes as themselves, the
    others, in order, from U+0100 on (fixed rule of the format)."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(0x100 + i) for i, b in enumerate(rest)}


_BYTES = _byte_letters()
_FORMATS = [f"<{n}I" for n in range(32)]
_ID = attrgetter("id")


def _packed(ids: Iterable[int]) -> bytes:
    ids = tuple(ids)
    n = len(ids)
    return struct.pack(_FORMATS[n] if n < len(_FORMATS) else f"<{n}I", *ids)


def worker_state(key: tuple, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task.  Functions come pickled by value, so
    what outlives a task stands in a module of its own."""
    held = vars(sys.modules.setdefault("txwatch_worker_state", ModuleType("txwatch_worker_state")))
    if key not in held:
        held[key] = make()
    return held[key]


def worker_encoder(path: str, chunks: tuple[Callable, Callable, bool], cache: int = CACHE) -> Encoder:
    """The Python worker's encoder for a vocabulary; the next tasks of the worker find the
    chunks that earlier ones met."""
    return worker_state(("encoder", path, cache), lambda: Encoder(path, chunks, cache))


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes.  The dictionary itself holds the
    chunks met lately; where chunks take a space, that space is left out of the key, and a key
    that begins with a line end stands for that line end and a chunk without a space.  Once it has half of ``cache`` they become the older ones, those before
    are forgotten, and older ones that are met again come back: frequent chunks stay."""

    def __init__(self, path: str, chunks: tuple[Callable, Callable, bool], cache: int = CACHE) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.whole, self.tokenize, self.split = whole, whole.model.tokenize, whole.pre_tokenizer.pre_tokenize_str
        self.tidy = whole.normalizer.normalize_str if whole.normalizer else None
        special = [t.content for t in whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        *self.chunks, self.led = chunks
        self.cache = cache
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, list[str]] = {}

    def word(self, c: str) -> str:
        """The model's piece for a plain word; empty if ``c`` is another kind of chunk."""
        if (c[1:] if c[:1] == " " else c).isalpha():
            low = c.lower() if self.tidy else c
            if c.isascii():
                return low.replace(" ", _BYTES[32])
            if not self.tidy or is_normalized("NFC", c) and "\u03a3" not in c and low.isalpha():
                return low.encode().decode("latin-1").translate(_BYTES)
        return ""

    def pieces(self, c: str) -> list[str]:
        """The model's pieces of one chunk.  Plain words are their own pieces, the marks that
        close one are pieces beside it; all else goes through the library's normaliser and
        pre-tokenizer."""
        body = c.rstrip(_MARKS)
        marks = c[len(body):]
        own = self.word(body) if len(marks) <= TAIL else ""
        if not own:
            return [piece for piece, _ in self.split(self.tidy(c) if self.tidy else c)]
        if marks and marks not in self.tails:      # bounded: few marks, TAIL of them at most
            self.tails[marks] = [piece for piece, _ in self.split(marks)]
        return [own, *self.tails[marks]] if marks else [own]

    def bare(self, c: str) -> bytes:
        """Ids of a chunk that has no space before it."""
        return self["\n" + c][len(self["\n"]):] if self.led else self[c]

    def fresh(self, key: str) -> bytes:
        """Ids of a key that is not held; of a word with closing marks the word may be."""
        body = key.rstrip(_MARKS)
        if body != key:
            word, marks = body.removeprefix("\n") if self.led else body, key[len(body):]
            if word.isalpha() and len(marks) <= TAIL and (own := self.get(body) or self.older.get(body)):
                return own + self.bare(marks)
        if not self.led:
            c, before = key, b""
        elif key[:1] != "\n":
            c, before = f" {key}", b""
        elif len(key) > 1:
            c, before = key[1:], self["\n"]
        else:
            c, before = key, b""
        if body == key and (own := self.word(c)):
            return before + _packed(map(_ID, self.tokenize(own)))
        return before + _packed(t.id for piece in self.pieces(c) for t in self.tokenize(piece))

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.cache // 2:
            self.older = dict(self)
            self.clear()
        out = self[key] = self.older.get(key) or self.fresh(key)
        return out

    def ids(self, text: str) -> bytes:
        if self.special(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if self.led and not any(x in text for x in _RARE):
            first, *keys = text.replace("\n", " \n").split(" ")
            return (self.bare(first) if first else b"") + b"".join(map(self.__getitem__, keys))
        found = self.chunks[any(c in text for c in _ODD)](text)
        if self.led:
            return b"".join(self[c[1:]] if c[0] == " " and c[1:2] != "\n" else self.bare(c) for c in found)
        return b"".join(map(self.__getitem__, found))
