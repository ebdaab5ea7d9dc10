"""Ids of texts by way of their distinct words.

A tokenizer that never looks across certain boundaries gives a text the ids of its
words, one after the other. Each task encodes a word once and keeps the result; the
memory of that is bounded, as the table starts anew when it is full.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

#: Words a task remembers, and words encoded in one call.
REMEMBERED, CALL = 800_000, 20_000

_BLANKS = bytes.maketrans(b"\n\t", b"  ")
_KIND = np.zeros(256, np.uint8)  # 1: ASCII letters and digits, 2: ASCII punctuation
for _byte in range(33, 127):
    _KIND[_byte] = 1 if chr(_byte).isalnum() else 2


def cut_words(texts: list[str | None]) -> list[list[bytes]]:
    """Words of each text: between spaces, tabs and line feeds, and ASCII punctuation
    apart from a letter or digit in front of it.

    For tokenizers that drop blanks and whose tokens hold no letter or digit in front of
    punctuation; only their special tokens may, which are written with ``<|``.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(encoded).translate(_BLANKS), np.uint8)
    kind = _KIND[data]
    apart = np.flatnonzero((kind[1:] == 2) & (kind[:-1] == 1)) + 1
    spaced = np.insert(data, apart, 32).tobytes()
    ends = np.cumsum([len(e) + 1 for e in encoded])
    starts = ends - [len(e) + 1 for e in encoded]
    new_starts = starts + np.searchsorted(apart, starts)
    new_ends = ends - 1 + np.searchsorted(apart, ends - 1)
    return [e.translate(_BLANKS).split(b" ") if b"<|" in e else spaced[a:b].split(b" ")
            for e, a, b in zip(encoded, new_starts.tolist(), new_ends.tolist(), strict=True)]


class _Codes(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word):
        self[word] = code = len(self)
        return code


class WordTable:
    """Word to ids, grown on demand; ``encode`` gets sorted distinct words and returns
    the ids of all of them in one array, and their number per word."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self._encode, self._remembered = encode, remembered
        self._clear()

    def _clear(self) -> None:
        self._codes = _Codes()
        self._ids = np.empty(1 << 16, np.uint32)
        self._start = self._length = np.zeros(0, np.int64)  # of each word's ids in _ids
        self._used = 0

    def _learn(self, words: list) -> None:
        """Append the ids of the words that were numbered last."""
        order = sorted(range(len(words)), key=words.__getitem__)
        start, length = np.empty((2, len(words)), np.int64)
        for at in range(0, len(order), CALL):
            part = order[at : at + CALL]
            flat, counts = self._encode([words[i] for i in part])
            end = self._used + len(flat)
            if end > len(self._ids):
                self._ids = np.concatenate([self._ids[: self._used], np.empty(2 * end - self._used, np.uint32)])
            self._ids[self._used : end] = flat
            start[part] = self._used + np.cumsum(counts) - counts
            length[part], self._used = counts, end
        self._start = np.concatenate([self._start, start])
        self._length = np.concatenate([self._length, length])

    def ids(self, texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (given as words) in one array, and their number per text."""
        if len(self._codes) > self._remembered:
            self._clear()
        known = len(self._codes)
        codes = np.array(list(map(self._codes.__getitem__, chain.from_iterable(texts))), np.int64)
        if len(self._codes) > known:
            self._learn(list(self._codes)[known:])
        counts = self._length[codes]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        flat = self._ids[np.arange(total) + np.repeat(self._start[codes] - (ends - counts), counts)]
        # ids of a text: from the words before it to its own last word
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)]
        return flat, np.diff(bounds)
