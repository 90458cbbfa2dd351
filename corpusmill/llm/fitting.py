"""Fitting linear models of hashed text features on a bounded sample of labelled rows.

The sample's texts become sparse rows where they are read, one text for each
labelled key, and one task fits the model on them, whatever their number. So no
text and no feature row passes through the driver; it gets one weight vector of
fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About so many labelled rows are used at most, chosen by a hash of the key.
SAMPLE_ROWS = 8192

Features = Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]]


def sample(labels: DataFrame, key: str, target: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About `rows` labelled keys at most, with `__target`; nulls and repeats are left out."""
    known = labels.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{target}`").isNotNull())
    known = known.groupBy(F.col(f"`{key}`").alias("__key")).agg(F.max(f"`{target}`").alias("__target"))
    share = min(1.0, rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("__key"), F.lit(1 << 20))
    return known.filter(place < int(share * (1 << 20)))


def labelled_texts(table: DataFrame, labelled: DataFrame, key: str, text: str) -> DataFrame:
    """(__key, __target, __text) of a bounded sample; of several texts of a key the least one counts."""
    texts = table.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text"))
    least = texts.join(F.broadcast(labelled), "__key").groupBy("__key", "__target").agg(F.min("__text").alias("__text"))
    return least


def sparse_rows(
    table: DataFrame, labelled: DataFrame, features: Features, key: str, text: str
) -> DataFrame:
    """(target, places, values) of the labelled texts; `labelled` is a bounded sample."""
    texts = labelled_texts(table, labelled, key, text).select(F.col("__target").cast("int").alias("target"), "__text")

    def run(batches):
        for batch in batches:
            rows = list(features(batch["__text"]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["target"],
                    pa.array([places.astype("<i4").tobytes() for places, _ in rows], pa.binary()),
                    pa.array([values.astype("<f4").tobytes() for _, values in rows], pa.binary()),
                ],
                ["target", "places", "values"],
            )

    return texts.mapInArrow(run, "target int, places binary, values binary")


def fit(rows: DataFrame, learn: Callable, size: int) -> np.ndarray:
    """The model that `learn(targets, places, values)` gives; zeros where there is no labelled row."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["target", "places", "values"], ignore_index=True)
        part = part.sample(frac=1, random_state=7, ignore_index=True)
        places = [np.frombuffer(p, "<i4") for p in part["places"]]
        values = [np.frombuffer(v, "<f4").astype(np.float64) for v in part["values"]]
        model = learn(part["target"].to_numpy(), places, values)
        return pd.DataFrame({"model": [model.astype("<f8").tobytes()]})

    fitted = rows.groupBy(F.lit(0).alias("all")).applyInPandas(run, "model binary").collect()
    return np.frombuffer(bytes(fitted[0]["model"]), "<f8").copy() if fitted else np.zeros(size)
