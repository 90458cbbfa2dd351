"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features are the hashed lower-case words of a text and their starts of 4, 5 and
6 bytes, each present or not. Severity grades 0 to K share one weight vector;
P(grade > k) = logistic(w x - threshold k), with ordered thresholds. The output
is the expected severity, the sum of these probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import fitting, words
from corpusmill.runtime import materialize

BITS = 18
GRADES = 3
STEPS = 300
STARTS = (0, 4, 5, 6)  # 0: the whole word
REJECT_AT = 0.5


def _marks(part: words.Slice) -> Iterator[np.ndarray]:
    """For each kind of feature the hashed place of each word; words are runs of letters or digits."""
    for start in STARTS:
        place = words.mix(part.hashes(lower=True, prefix=start) + np.uint64(start + 1))
        yield (place >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for part in words.slices(texts, classes=words.TOKEN_CLASSES):
        kinds = list(_marks(part))
        for i in range(part.n_texts):
            own = slice(part.bounds[i], part.bounds[i + 1])
            places = np.unique(np.concatenate([place[own] for place in kinds]))
            yield places, np.ones(len(places))


def _thresholds(free: np.ndarray) -> np.ndarray:
    """The first threshold and the logarithms of the steps to the next."""
    return np.cumsum(np.append(free[0], np.exp(free[1:])))


def _screened(flags: np.ndarray, places: list[np.ndarray], least: float) -> list[np.ndarray]:
    """The places of telling features only."""
    sizes = np.fromiter(map(len, places), np.int64, len(places))
    every, flagged = np.concatenate(places), np.repeat(flags, sizes)
    n, n1 = len(flags), flags.sum()
    df = np.bincount(every, minlength=1 << BITS).astype(float)
    df1 = np.bincount(every[flagged], minlength=1 << BITS)
    expected = df * n1 / n
    spread = np.maximum(df * (n - df) * n1 * (n - n1) / (n * n * max(1, n - 1)), 1e-9)
    telling = (df1 - expected) ** 2 / spread >= least
    return [at[telling[at]] for at in places]


def learn(
    targets: np.ndarray, places: list[np.ndarray], values: list[np.ndarray],
    rate: float = 0.3, l2: float = 1e-4, screen: float = 25.0,
) -> np.ndarray:
    """Adaptive gradient steps over all rows; returns the weights and the thresholds.

    Only features whose presence depends on the grade being over 0 take part: the
    chi-square statistic of the two reaches `screen`.

    With F(k) = P(grade > k), the likelihood of a grade g is F(g-1) - F(g), where
    F(-1) = 1 and F(K) = 0; its logarithm has the derivative 1 - F(g-1) - F(g) by
    w x.
    """
    n, rows = len(targets), np.arange(len(targets))
    places = _screened(targets > 0, places, screen)
    owner = np.repeat(rows, np.fromiter(map(len, places), np.int64, n))
    telling, column = np.unique(np.concatenate(places), return_inverse=True)
    weights, squares = np.zeros(len(telling)), np.full(len(telling), 1e-8)
    free, free_squares = np.append(2.0, np.zeros(GRADES - 1)), np.full(GRADES, 1e-8)
    for _ in range(STEPS):
        limits = _thresholds(free)
        total = np.bincount(owner, weights[column], minlength=n)
        above = 1 / (1 + np.exp(np.clip(limits - total[:, None], -35, 35)))
        bounded = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        over, under = bounded[rows, targets], bounded[rows, targets + 1]
        pull = np.bincount(column, (1 - over - under)[owner], minlength=len(telling)) / n - l2 * weights
        squares += pull * pull
        weights += rate * pull / np.sqrt(squares)
        slope = above * (1 - above) / np.maximum(over - under, 1e-9)[:, None]
        by_limit = np.zeros(GRADES)
        for k in range(GRADES):
            by_limit[k] = slope[targets == k, k].sum() - slope[targets == k + 1, k].sum()
        by_free = np.cumsum(by_limit[::-1])[::-1] / n
        by_free[1:] *= np.exp(free[1:])
        free_squares += by_free * by_free
        free += rate * by_free / np.sqrt(free_squares)
        free[1:] = np.clip(free[1:], -4, 4)
    model = np.zeros(1 << BITS)
    model[telling] = weights
    return np.append(model, _thresholds(free))


def severity_grades(labels: DataFrame, flag: str, table: DataFrame, key: str = "doc_id", text: str = "text",
                    rows: int = fitting.SAMPLE_ROWS) -> DataFrame:
    """Grades of labelled rows where only a flag is known: (key, grade).

    0: not flagged. Flagged texts are graded 1 to GRADES by thirds of the number of
    their different telling features: those that at least five flagged texts of the
    sample hold, and no more clean texts than one in fifty of these.
    """
    labelled = fitting.sample(labels, key, flag, rows)
    texts = fitting.labelled_texts(table, labelled, key, text).toDF("key", "flag", "text")
    size = 1 << BITS

    def count(batches):
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            for flagged, (places, _) in zip(batch["flag"].to_pylist(), features(batch["text"]), strict=True):
                total[int(flagged > 0), places] += 1
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[1, at]), pa.array(total[0, at])], ["place", "flagged", "clean"]
        )

    counts = texts.mapInArrow(count, "place bigint, flagged bigint, clean bigint")
    counts = counts.groupBy("place").agg(F.sum("flagged").alias("f"), F.sum("clean").alias("c"))
    telling = counts.filter("f >= 5 AND c * 50 <= f").select("place").toPandas()["place"].to_numpy(np.int64)
    known = table.sparkSession.sparkContext.broadcast(np.isin(np.arange(size), telling))

    def number(batches):
        for batch in batches:
            counts = [int(known.value[places].sum()) for places, _ in features(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["flag"], pa.array(counts, pa.int64())], ["key", "flag", "n"]
            )

    kinds = {field.name: field.dataType.simpleString() for field in texts.schema}
    numbers = texts.mapInArrow(number, f"key {kinds['key']}, flag {kinds['flag']}, n bigint")
    cuts = numbers.filter("flag > 0").approxQuantile("n", [i / GRADES for i in range(1, GRADES)], 0.01)
    grade = F.lit(1)
    for cut in cuts:
        grade = grade + (F.col("n") > cut).cast("int")
    return numbers.select(F.col("key").alias(key), F.when(F.col("flag") > 0, grade).otherwise(0).alias("grade"))


def fit(
    table: DataFrame, graded: DataFrame, target: str = "grade", key: str = "doc_id", text: str = "text",
    rows: int = fitting.SAMPLE_ROWS,
) -> np.ndarray:
    """Weights and thresholds from about `rows` rows graded 0 to GRADES at most.

    Without any graded row the model is zeros with thresholds out of reach.
    """
    labelled = fitting.sample(graded, key, target, rows)
    sparse = fitting.sparse_rows(table, labelled, features, key, text)
    model = fitting.fit(sparse, learn, (1 << BITS) + GRADES)
    if not model.any():
        model[-GRADES:] = 35.0
    return model


def fit_flags(
    table: DataFrame, labels: DataFrame, flag: str = "toxic", key: str = "doc_id", text: str = "text",
    rows: int = fitting.SAMPLE_ROWS,
) -> np.ndarray:
    """A model from a flag instead of grades, on about `rows` labelled rows at most."""
    graded = materialize(severity_grades(labels, flag, table, key, text, rows), "grades")
    return fit(table, graded, "grade", key, text, rows)


def _severity(texts: pa.Array, model: np.ndarray) -> np.ndarray:
    """P(grade > k) for each text and k."""
    weights, limits = model[:-GRADES], model[-GRADES:]
    sums = [np.zeros(0)]
    for part in words.slices(texts, classes=words.TOKEN_CLASSES):
        owner = part.text_of_word()
        found = []
        for place in _marks(part):
            hit = weights[place] != 0
            found.append(owner[hit] << BITS | place[hit])
        distinct = np.unique(np.concatenate(found))  # each feature counts once a text
        own = weights[distinct & ((1 << BITS) - 1)]
        sums.append(np.bincount(distinct >> BITS, own, minlength=part.n_texts))
    total = np.concatenate(sums)
    return 1 / (1 + np.exp(np.clip(limits - total[:, None], -35, 35)))


def score(
    table: DataFrame, model: np.ndarray, key: str = "doc_id", text: str = "text", reject_at: float = REJECT_AT
) -> DataFrame:
    """One row per row of `table`: key, `severity`, `grade` and `toxic`.

    `severity` is the expected grade, `grade` the likeliest one by the thresholds
    (the number of k with P(grade > k) of a half or more), `toxic` tells that
    P(grade > 0) reaches `reject_at`. A null or empty text has no features.
    Repeated rows score alike; other columns are left out; an empty table gives
    an empty result.
    """
    shared = table.sparkSession.sparkContext.broadcast(model)
    kept = table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            above = _severity(batch["text"], shared.value)
            columns = [
                batch["key"],
                pa.array(above.sum(axis=1)),
                pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                pa.array(above[:, 0] >= reject_at),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "severity", "grade", "toxic"])

    kind = kept.schema["key"].dataType.simpleString()
    made = kept.mapInArrow(run, f"key {kind}, severity double, grade int, toxic boolean")
    return made.withColumnRenamed("key", key)


def keep_clean(
    table: DataFrame, model: np.ndarray, text: str = "text", reject_at: float = REJECT_AT
) -> DataFrame:
    """The rows of `table` that `score` does not call toxic, with all their columns, in one pass.

    Rows without text stay unless the model rejects a text without features; null
    keys, repeated rows and columns of any name pass; an empty table stays empty.
    """
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            above = _severity(batch[text].cast(pa.string()), shared.value)
            yield batch.filter(pa.array(above[:, 0] < reject_at))

    return table.mapInArrow(run, table.schema)
