"""Quality of documents: hashed word n-grams, logistic regression, FTRL-proximal.

Words are runs of letters, digits or marks. Features are the hashed single words
and pairs, and single forms, pairs and triples of forms: a form is a word's
class, case, size and whether it repeats the word before it, so that junk made
of rare words is known by its pattern. Values are shares of a text, so a score
is a dot product that needs one pass over the words and no sorting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import fitting, words

BITS = 18
EPOCHS = 8
THRESHOLD = 0.3
_BIAS = 1 << BITS


def _grams(part: words.Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: the text of each occurrence and its hashed place."""
    owner = part.text_of_word()
    values = part.hashes(lower=True)
    first, last = part.data[part.starts], part.data[part.ends - 1]
    upper = lambda c: (c >= 65) & (c <= 90)
    size = np.minimum(3, np.log2(part.ends - part.starts).astype(np.uint64))
    repeat = np.zeros(len(values), np.uint64)
    repeat[1:] = (values[1:] == values[:-1]) & (owner[1:] == owner[:-1])
    forms = part.kinds.astype(np.uint64) | size << np.uint64(2) | repeat << np.uint64(4)
    forms |= upper(first).astype(np.uint64) << np.uint64(5) | upper(last).astype(np.uint64) << np.uint64(6)
    marks = part.kinds == 3
    forms = np.where(marks, values, forms)  # each mark is a form of its own
    for kind, (units, n) in enumerate(((values, 1), (values, 2), (forms, 1), (forms, 2), (forms, 3))):
        whole = owner[: max(0, len(owner) - n + 1)] == owner[n - 1 :]
        place = words.mix(words.chain(units, n) + np.uint64(kind)) >> np.uint64(64 - BITS)
        yield owner[: len(whole)][whole], place.astype(np.int64)[whole]


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse rows: hashed places and the share of each among its kind."""
    for part in words.slices(texts, classes=words.TOKEN_CLASSES):
        kinds = [(owner, place, np.bincount(owner, minlength=part.n_texts)) for owner, place in _grams(part)]
        bounds = [np.searchsorted(owner, np.arange(part.n_texts + 1)) for owner, _, _ in kinds]
        for i in range(part.n_texts):
            places, shares = [np.array([_BIAS])], [np.ones(1)]
            for (_, place, counts), bound in zip(kinds, bounds, strict=True):
                distinct, n = np.unique(place[bound[i] : bound[i + 1]], return_counts=True)
                places.append(distinct)
                shares.append(n / max(1, counts[i]))
            yield np.concatenate(places), np.concatenate(shares)


def learn(
    targets: np.ndarray, places: list[np.ndarray], values: list[np.ndarray],
    alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3,
) -> np.ndarray:
    """Follow the regularised leader, one labelled row after the other."""
    z, n = np.zeros(_BIAS + 1), np.zeros(_BIAS + 1)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(EPOCHS):
        for target, at, x in zip(targets, places, values, strict=True):
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            gradient = (p - target) * x
            square = gradient * gradient
            rate = (np.sqrt(n[at] + square) - np.sqrt(n[at])) / alpha
            # A place may stand for features of several kinds.
            np.add.at(z, at, gradient - rate * w)
            np.add.at(n, at, square)
    return weights(slice(None))


def fit(
    table: DataFrame, labels: DataFrame, target: str, key: str = "doc_id", text: str = "text",
    rows: int = fitting.SAMPLE_ROWS,
) -> np.ndarray:
    """Weights from about `rows` labelled rows at most; zeros without any."""
    labelled = fitting.sample(labels, key, target, rows)
    sparse = fitting.sparse_rows(table, labelled, features, key, text)
    return fitting.fit(sparse, learn, _BIAS + 1)


def score(
    table: DataFrame, model: np.ndarray, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of `table`: key, `score` from 0 to 1 and `predicted` (1 from the threshold on).

    Whole texts count. A null or empty text has the score of the bias alone.
    Repeated rows score alike; other columns are left out, so none can clash. An
    empty table gives an empty result.
    """
    weights = table.sparkSession.sparkContext.broadcast(model)
    kept = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for part in words.slices(batch["text"], classes=words.TOKEN_CLASSES):
                total = np.full(part.n_texts, weights.value[_BIAS])
                for owner, place in _grams(part):
                    counts = np.bincount(owner, minlength=part.n_texts)
                    sums = np.bincount(owner, weights.value[place], minlength=part.n_texts)
                    total += sums / np.maximum(counts, 1)
                scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(np.concatenate(scores))], ["key", "score"])

    kind = kept.schema["key"].dataType.simpleString()
    scored = kept.mapInArrow(run, f"key {kind}, score double")
    return scored.select(
        F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
