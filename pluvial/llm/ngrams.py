"""Character n-grams of a text's words by array operations.

Words are split at white space, lower-cased, and lose the marks at their edges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 18     # characters read at once

_EDGE = np.zeros(0x110000, bool)
_EDGE[[ord(c) for c in ".,;:!?\"'()[]{}<>«»„“”‘’…"]] = True
_BASE = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(r"\s")


def chunks(text: str) -> Iterator[str]:
    """The text in parts of about CHUNK characters, cut at white space."""
    at = 0
    while len(text) - at > CHUNK:
        space = _SPACE.search(text, at + CHUNK)
        if space is None:
            break
        yield text[at:space.start()]
        at = space.end()
    yield text[at:]


class Words:
    """The words of a text, marked <word>, one after the other as code points."""

    def __init__(self, text: str) -> None:
        words = text.lower().split()
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length)
        start = end - length
        if len(words):   # leave marks at a word's edges out
            at = np.arange(len(code))
            inner = ~_EDGE[code]
            first = np.minimum.reduceat(np.where(inner, at, len(code)), start)
            last = np.maximum.reduceat(np.where(inner, at, -1), start)
            length = np.maximum(last - first + 1, 0)
            start = np.where(length > 0, first, start)
        self.size = length + 2
        self.start = np.cumsum(self.size) - self.size
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.at = np.arange(len(self.word)) - self.start[self.word]
        inside = (self.at > 0) & (self.at <= length[self.word])
        self.code = np.where(self.at == 0, np.uint64(ord("<")), np.uint64(ord(">")))
        self.code[inside] = code[(start[self.word] + self.at - 1)[inside]]

    def grams(self, orders: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket, place) of the n-grams of each order, then of whole words.

        buckets: a power of two.
        """
        shift = np.uint64(64 - (buckets.bit_length() - 1))
        total, power = np.zeros(len(self.code), np.uint64), 1
        left = self.size[self.word] - self.at     # characters from here to the word's end
        for n in range(1, max(orders) + 1):
            if n <= len(total):
                total[:len(total) - n + 1] += self.code[n - 1:] * np.uint64(power)
            power = power * int(_BASE) % (1 << 64)
            if n in orders:
                place = np.flatnonzero(left >= n)
                yield (((total[place] + np.uint64(n)) * _SPREAD) >> shift).astype(np.int64), place
        yield (self.whole() >> shift).astype(np.int64), self.start

    def whole(self) -> np.ndarray:
        """A 64-bit hash of each word as a whole."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        powers = np.cumprod(np.full(int(self.size.max()), _BASE, np.uint64))
        return np.add.reduceat(self.code * powers[self.at], self.start) * _SPREAD
