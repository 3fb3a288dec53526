"""Matches of the public splitting pattern, and a bounded memory of words.

Byte-level BPE encodes every match of ``public_tokenizers.PATTERN`` by itself.
The ``regex`` module finds the matches; its letters and numbers may be of
another Unicode version than the tokenizer libraries'. The code points on which
they differ are asked from the library once in a worker, and a text that holds
one is split with that code point's class changed to the library's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cache

import numpy as np
import public_tokenizers
import regex

GENERATION_WORDS = 400_000  # words that a generation of the memory holds
GENERATION_BYTES = 24 << 20
_SLICE_WORDS = 65_536  # new words that are learnt at once


@cache
def _matcher() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


@cache
def _library_classes() -> tuple[np.ndarray, dict[int, str]]:
    """The code points that ``regex`` holds in another class than the library
    (as a mask), and for each a character of the library's class."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    changed = {}
    for kind, stand_in in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", "\t")):
        library = tiktoken.Encoding(kind, pat_str=kind + "+", mergeable_ranks=single, special_tokens={})
        known = set(bytes(library.encode_ordinary(every)).decode())
        for c in known.symmetric_difference(regex.findall(kind, every)):
            changed[ord(c)] = stand_in if c in known else changed.get(ord(c), "\ufffd")
    unlike = np.zeros(0x110000, bool)
    unlike[list(changed)] = True
    return unlike, changed


def unlike(text: str) -> bool:
    """Whether the text holds a code point on which the modules differ."""
    return not text.isascii() and bool(_library_classes()[0][np.frombuffer(text.encode("utf-32-le"), "<u4")].any())


def words(text: str) -> list[str]:
    """The matches of the pattern, in order; together they are the text."""
    if unlike(text):
        # One code point for one, so the places of the matches stay.
        stand_in = text.translate(_library_classes()[1])
        return [text[m.start() : m.end()] for m in _matcher().finditer(stand_in)]
    return _matcher().findall(text)


class WordMemory:
    """What a worker has learnt about words, in two generations: a word met
    again moves to the young one; when that is full it becomes the old one,
    whose other words are forgotten."""

    def __init__(self, learn: Callable[[list[str]], Iterable[bytes]]):
        self.learn = learn
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def know(self, wanted: set[str]) -> Callable[[str], bytes]:
        """A look-up that holds all ``wanted`` words until the next call."""
        if len(self.young) > GENERATION_WORDS or self.held > GENERATION_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        new = []
        for w in wanted.difference(self.young):
            known = self.old.get(w)
            if known is None:
                new.append(w)
            else:
                self.young[w] = known
                self.held += len(w)
        for a in range(0, len(new), _SLICE_WORDS):
            part = new[a : a + _SLICE_WORDS]
            self.young.update(zip(part, self.learn(part), strict=True))
            self.held += sum(map(len, part))
        return self.young.__getitem__
