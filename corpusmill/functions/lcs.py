"""The worker side of ROUGE-L: plain Python on one pair of texts at a time."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import cloudpickle

# Workers get this module's functions with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Bit masks kept per pair of texts; rarer tokens of very long texts are rebuilt.
MASK_BYTES = 1 << 28


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence with one bit per token of `b` (Hyyro, 2004).

    A whole row of the usual table is one integer, so a token of `a` costs one
    addition over len(b)/64 machine words and no text has to be cut short.
    """
    places: dict[str, list[int]] = {}
    for i, token in enumerate(b):
        places.setdefault(token, []).append(i)
    width = len(b) // 8 + 1

    @lru_cache(maxsize=max(1, MASK_BYTES // width))
    def mask(token: str) -> int:
        bits = bytearray(width)
        for i in places[token]:
            bits[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(bits, "little")

    full = (1 << len(b)) - 1
    row = full
    for token in a:
        if token in places:
            hits = row & mask(token)
            row = ((row + hits) | (row - hits)) & full
    return len(b) - row.bit_count()


def rouge_l_f1(prediction: str, reference: str) -> float:
    p, r = prediction.split(), reference.split()
    common = lcs_length(p, r) if p and r else 0
    if common == 0:
        return 0.0
    precision, recall = common / len(p), common / len(r)
    return 2 * precision * recall / (precision + recall)


def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The body of the ROUGE-L UDF; null where either side is null."""
    for predictions, references in batches:
        yield pd.Series(
            [
                None if p is None or r is None else rouge_l_f1(p, r)
                for p, r in zip(predictions, references)
            ],
            dtype="float64",
        )
