"""Vectorised words of whole texts: splitting and hashing over Arrow buffers.

A word is a longest run of bytes other than space and 0x09 to 0x0D. Texts are
taken in slices of bounded bytes, so that a batch never needs much more memory
than its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BLANKS = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
#: Words are whatever stands between blanks.
WORD_CLASSES = np.ones(256, dtype=np.uint8)
WORD_CLASSES[_BLANKS] = 0
#: Letters (1; also every byte of a non-ASCII character), digits (2) and marks (3) apart.
TOKEN_CLASSES = np.full(256, 3, dtype=np.uint8)
TOKEN_CLASSES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
TOKEN_CLASSES[48:58] = 2
TOKEN_CLASSES[_BLANKS] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _multipliers(bits: int, seed: int) -> np.ndarray:
    steps = np.arange(1, (1 << bits) + 1, dtype=np.uint64) + np.uint64(seed << 40)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """At least `n` odd multipliers, one for each position."""
    return _multipliers(max(10, int(n).bit_length()), seed)


class Slice:
    """Words of consecutive texts: byte places, and the first word of each text.

    A word is a longest run of bytes of one class; class 0 separates.
    """

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> None:
        self.first = first  # row of the first text in its batch
        self.data = data
        self.offsets = offsets
        self.n_texts = len(offsets) - 1
        kinds = classes[data]
        edge = np.ones(len(data) + 1, dtype=bool)
        edge[1:-1] = kinds[1:] != kinds[:-1]
        edge[offsets] = True
        inside = kinds != 0
        self.starts = np.flatnonzero(edge[:-1] & inside)
        self.ends = np.flatnonzero(edge[1:] & inside) + 1
        self.kinds = kinds[self.starts]
        self.bounds = np.searchsorted(self.starts, offsets)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), np.diff(self.bounds))

    def hashes(self, lower: bool = False, seed: int = 0, prefix: int = 0) -> np.ndarray:
        """A 64-bit value for each word, or for its first `prefix` bytes.

        Bytes are summed under random odd multipliers by position, modulo 2^64.
        """
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        if prefix:
            lengths = np.minimum(lengths, prefix)
        before = np.cumsum(lengths) - lengths
        place = np.arange(before[-1] + lengths[-1]) - np.repeat(before, lengths)
        chars = self.data[place + np.repeat(self.starts, lengths)]
        if lower:
            chars = _LOWER[chars]
        terms = (chars.astype(np.uint64) + np.uint64(1)) * multipliers(lengths.max(), seed)[place]
        return mix(np.add.reduceat(terms, before) + lengths.astype(np.uint64))


def slices(
    texts: pa.Array, limit: int = SLICE_BYTES, classes: np.ndarray = WORD_CLASSES
) -> Iterator[Slice]:
    """Slices of a string array of at most `limit` bytes, or of one text; null is empty."""
    texts = texts.fill_null("").cast(pa.large_utf8())
    if not len(texts):
        return
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        own = offsets[at : to + 1]
        yield Slice(at, data[own[0] : own[-1]], own - own[0], classes)
        at = to


def chain(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit value for every `n` consecutive entries."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for i, factor in enumerate(multipliers(n, 7)[:n]):
        total += words[i : i + count] * factor
    return mix(total)


def shingle_sets(part: Slice, n: int, lower: bool) -> Iterator[np.ndarray]:
    """For each text its sorted distinct `n`-word values; fewer words count as one."""
    words = part.hashes(lower)
    grams = chain(words, n)
    for i in range(part.n_texts):
        a, b = part.bounds[i], part.bounds[i + 1]
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield chain(words[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)
