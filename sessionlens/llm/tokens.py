"""Whole-text encoding with a public tokenizer file, word by word.

``word_bpe_49k.json`` drops white space and never joins across it, so the ids
of a text are the ids of its white-space separated words one after another.
Each Python worker encodes a word once and keeps its ids (bounded memory);
``tests/llm`` compare this with encoding whole texts.
"""

from __future__ import annotations

import os

import numpy as np
import public_tokenizers

from sessionlens.llm.common import chunks, kept, release

TOKENIZER = "word_bpe_49k.json"
GENERATION_WORDS = 500_000  # words that a generation of the cache holds
GENERATION_BYTES = 32 << 20
_CHUNK_BYTES = 1 << 18
_SLICE_WORDS = 8192  # words that the library encodes at once
_JOINED_WORDS = 512  # words that are joined to one text


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.separator = special[-1] if special else None
        # Two generations: a word that is met again moves to the young one, and
        # when that is full it becomes the old one, whose other words go.
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held, self.most = 0, GENERATION_WORDS

    def _learn(self, words: set[bytes]) -> None:
        if len(self.young) > self.most or self.held > GENERATION_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        new = []
        for w in words.difference(self.young):
            ids = self.old.get(w)
            if ids is None:
                new.append(w)
            else:
                self.young[w] = ids
                self.held += len(w)
        for a in range(0, len(new), _SLICE_WORDS):
            part = new[a : a + _SLICE_WORDS]
            self.young.update(zip(part, self._encode_words(part), strict=True))
            self.held += sum(map(len, part))

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_words(self, part: list[bytes]) -> list[bytes]:
        """The ids of each word. Words are joined by a special token, at which
        the library cuts a text, and the ids are cut at its id again: fewer and
        longer calls. Where the cuts are not one less than the words (a word
        holds the token itself), words are encoded one by one."""
        words = [w.decode("utf-8", "replace") for w in part]
        if self.separator is None:
            return self._one_by_one(words)
        groups = [words[a : a + _JOINED_WORDS] for a in range(0, len(words), _JOINED_WORDS)]
        encoded = self.tokenizer.encode_batch_fast([self.separator.join(g) for g in groups], add_special_tokens=False)
        mark, width = self.tokenizer.token_to_id(self.separator), self.dtype.itemsize
        out: list[bytes] = []
        for group, e in zip(groups, encoded, strict=True):
            ids = np.array(e.ids, self.dtype)
            cuts = np.flatnonzero(ids == mark) * width
            if len(cuts) != len(group) - 1 or any(self.separator in w for w in group):
                out += self._one_by_one(group)
                continue
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *(cuts + width).tolist()], [*cuts.tolist(), len(raw)], strict=True)]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian ``dtype``."""
        out: list[bytes] = []
        for a, b in chunks([len(t) for t in texts], _CHUNK_BYTES):
            split = [t.split() for t in texts[a:b]]
            self._learn(set().union(*split))
            get = self.young.__getitem__
            out += [b"".join(map(get, words)) for words in split]
        return out


def encoder(path: str | None = None, most: int = GENERATION_WORDS) -> WordEncoder:
    """The worker's encoder for a tokenizer file, which keeps about ``most``
    words a generation. What other operators kept in the worker goes."""
    path = path or public_tokenizers.path(TOKENIZER)
    name = f"words {path}"
    release(name)
    enc = kept(name, lambda: WordEncoder(path))
    enc.most = most
    return enc
