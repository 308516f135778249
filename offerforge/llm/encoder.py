"""Token ids of whole texts through the tokenizers library, keeping the ids of words seen before.

Both kinds of vocabulary cut a text at white space before they merge, so the ids of a text are the ids of its words in
order. A word costs a call into the library once; its ids are kept as little-endian bytes. The kept words are bounded
(``KEEP_WORDS`` that stay and ``LATE_WORDS`` that take turns), which changes the speed and never the ids. Python workers
outlive their tasks and would hold them beside whatever runs next, so ``release`` frees them where other stages follow.
"""

from __future__ import annotations

import ctypes
import gc
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

KEEP_WORDS = 500_000
LATE_WORDS = 100_000
LONGEST_KEPT = 64
#: White space as the vocabularies' patterns know it (Unicode White_Space).
SPACE = "\t-\r \x85\xa0  -     　"
#: What Python counts as white space besides.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class _Irregular(Exception):
    """White space other than single blanks and line feeds between words."""


class _Words(dict):
    """Ids by word. The first ``KEEP_WORDS`` words stay, as common words come early; later ones are held until there are
    ``LATE_WORDS`` of them, then these start anew."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.late = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.late.get(word)
        if ids is None:
            ids = self.encode(word)
            if len(word) > LONGEST_KEPT:
                return ids
            if len(self) < KEEP_WORDS:
                self[word] = ids
            else:
                if len(self.late) >= LATE_WORDS:
                    self.late.clear()
                self.late[word] = ids
        return ids


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others take the code points from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class TextEncoder:
    """``ids(text)``: the ids of the whole text as little-endian unsigned 32-bit bytes, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]  # a text that holds one of these strings is the library's alone
        self.model = self.library.model
        self.word_ends = bool(self.model.end_of_word_suffix)
        self.letters = _byte_letters()
        self.codes = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.marks = _Words(lambda marks: self._model(marks) if marks else b"")
        self.plain = _Words(self._plain_word)
        self.spaced = _Words(self._spaced_word)
        self.words = re.compile(f"[^{SPACE}]+").findall
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _model(self, *parts: str) -> bytes:
        cut, ids = self.model.tokenize, []
        for part in parts:
            ids += cut(part)
        return b"".join([self.codes[t.id] for t in ids])

    def _lettered(self, word: str) -> str:
        """The word in byte letters; printable ASCII is its own letter."""
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)

    def _plain_word(self, word: str) -> bytes:
        if self.word_ends:
            return self._word_with_end(word)
        return self._byte_word(word, "")

    def _spaced_word(self, word: str) -> bytes:
        return self._byte_word(word, " ")

    def _byte_word(self, word: str, space: str) -> bytes:
        """Letters with at most full stops and commas behind them go straight to the model: a merge never joins a letter
        and such a mark, so cutting them apart first would give the same ids."""
        letters = word.rstrip(".,")
        if letters.isalpha():
            if len(letters) < len(word):
                return (self.spaced if space else self.plain)[letters] + self.marks[word[len(letters) :]]
            return self._model((space and self.letters[32]) + self._lettered(word))
        if word.split() != [word] or not set(SEPARATORS).isdisjoint(word):
            raise _Irregular
        return self._library(space + word)

    def _word_with_end(self, word: str) -> bytes:
        """Words of Latin letters before U+0250 are already normalised; the marks behind them form one more word."""
        letters = word.rstrip(".,")
        if letters.isalpha() and max(letters) < "İ":
            low = letters.lower()
            if low == word:
                return self._model(self._lettered(low))
            return self.plain[low] + self.marks[word[len(letters) :]]
        return self._library(word)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._library(text)
        if self.word_ends:
            odd = any(c in text for c in SEPARATORS)
            return b"".join(map(self.plain.__getitem__, self.words(text) if odd else text.split()))
        plain, spaced, out = self.plain, self.spaced.__getitem__, []
        try:
            for line in text.split("\n"):
                first, *rest = line.split(" ")
                out.append(plain[first] + b"".join(map(spaced, rest)))
        except _Irregular:
            return self._chunked(text)
        return self._line_feed.join(out)

    @cached_property
    def _line_feed(self) -> bytes:
        return self._library("\n")

    def _chunked(self, text: str) -> bytes:
        """Any white space: a run keeps its last blank for the word behind it, as the vocabulary's pattern does."""
        out = []
        for chunk in self.chunks(text):
            word = chunk[1:] if chunk[0] == " " else chunk
            known = (self.spaced if chunk[0] == " " else self.plain).get(word) if word else None
            out.append(self._library(chunk) if known is None else known)
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder for each vocabulary and Python worker, until ``release``."""
    return TextEncoder(path)


def release() -> None:
    """Frees the encoders of this worker, at the end of a task, and gives the memory back where the C library can."""
    encoder.cache_clear()
    gc.collect()  # an encoder and its words refer to each other
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
