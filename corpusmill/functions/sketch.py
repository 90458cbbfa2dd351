"""The worker side of MinHash: numpy on one text at a time.

The hash family is defined by rule so that SQL can compute the same numbers:

* a shingle's hash x starts at 0; for each code point c, x = ((x xor c) * MIX)
  mod 2^32, then x = x xor (x >> 15);
* permutation k maps x to a_k * x mod 2^32 with a_k odd, taken from md5;
* the signature keeps the upper 31 bits of each minimum, so it fits an int.

The first rule already spreads x over 32 bits, so independent odd multipliers
are enough: tests measure the estimate's bias and spread. This step dominates
the cost of near-duplicate removal, and an added offset would be a third of it.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from corpusmill.fixed_values import NUM_PERM, SHINGLE_CHARS

# Texts are hashed together up to this many characters, or one by one if longer.
GROUP_CHARS = 1 << 15

# Workers get this module's functions with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIX = 0x7FEB352D
EMPTY = (1 << 31) - 1


def multiplier(k: int) -> int:
    """Odd and below 2^31, so that SQL can multiply within a bigint."""
    return int(hashlib.md5(f"a{k}".encode()).hexdigest()[:8], 16) % (1 << 31) | 1


MULTIPLIERS = [multiplier(k) for k in range(NUM_PERM)]
_A = np.array(MULTIPLIERS, dtype=np.uint32)[:, None]


def normalized(text: str) -> str:
    """The same text as `text.normalize` gives; cheaper here than one more JVM pass."""
    return " ".join(text.lower().split())


def shingle_hashes(text: str) -> np.ndarray:
    """One uint32 per shingle position of an already normalised text."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(points) - SHINGLE_CHARS + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    x, high = points[:n] * np.uint32(MIX), np.empty(n, dtype=np.uint32)
    x ^= np.right_shift(x, np.uint32(15), out=high)
    for i in range(1, SHINGLE_CHARS):
        x ^= points[i : i + n]
        x *= np.uint32(MIX)
        x ^= np.right_shift(x, np.uint32(15), out=high)
    return x


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a plain sort is much faster here than np.unique."""
    ordered = np.sort(hashes)
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


def minima(hashes: np.ndarray, block: int = 512) -> np.ndarray:
    """The 128 permuted minima, in blocks that stay in the CPU cache."""
    values = distinct(hashes)
    low = np.full(NUM_PERM, 0xFFFFFFFF, dtype=np.uint32)
    buffer = np.empty((NUM_PERM, min(block, len(values))), dtype=np.uint32)
    for start in range(0, len(values), block):
        part = values[start : start + block]
        permuted = np.multiply(_A, part, out=buffer[:, : len(part)])
        np.minimum(low, permuted.min(axis=1), out=low)
    return (low >> np.uint32(1)).astype(np.int32)


def _groups(batch: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    """Places and normalised texts of the valid rows, a bounded number of characters at a time."""
    places, group, size = [], [], 0
    for i, text in enumerate(batch):
        if not text.is_valid:
            continue
        told = normalized(text.as_py())
        if group and size + len(told) > GROUP_CHARS:
            yield places, group
            places, group, size = [], [], 0
        places.append(i)
        group.append(told)
        size += len(told)
    if group:
        yield places, group


def signatures(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The body of the signature UDF.

    Texts are taken out of the Arrow batch a few at a time, and the signatures are
    one flat array, so a worker holds little more than the batch itself. The texts
    of a group are hashed in one go; shingles that reach into the next text are left out.
    """
    for batch in texts:
        found = np.full((len(batch), NUM_PERM), EMPTY, dtype=np.int32)
        for places, group in _groups(batch):
            hashes, at = shingle_hashes("".join(group)), 0
            for i, text in zip(places, group):
                found[i] = minima(hashes[at : at + max(0, len(text) - SHINGLE_CHARS + 1)])
                at += len(text)
        ends = np.arange(len(batch) + 1, dtype=np.int32) * NUM_PERM
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()), mask=batch.is_null())
