"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are scaled to length one, so the largest cosine is the least Euclidean
distance, and are projected by a few Gaussian (2-stable) vectors. The square of
a projected distance is the true square times a chi-square variable with as many
degrees of freedom as projections.

The index holds every row: rows are dealt evenly to trees of at most about
`TREE_VALUES` numbers, and each tree is stored as its projected points and vectors
in leaf order, with the leaves' boxes. A query walks the leaves of a tree in
order of their distance in the projection, verifies the points that may still
matter by their true distance, and stops once the next leaf lies so far off that
a better neighbour there would be an outlier of the chi-square law (`CONFIDENCE`).
Trees are searched independently and their best rows are merged.

Queries are a stated set and come in blocks of bounded size, each broadcast to
the trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import materialize

PROJECTIONS = 8  # an even number, for the closed form of the chi-square law
CONFIDENCE = 0.97
TREE_VALUES = 1 << 19  # numbers in the vectors of a tree: 4 MB
ROWS_A_LEAF = 128
BLOCK_VALUES = 1 << 20  # numbers in a block of queries: 8 MB
_SEED = 20
_SLACK = 1e-9  # for rounding, where vectors are equal


def chi_square_quantile(p: float, freedom: int) -> float:
    """For an even number of degrees of freedom, by bisection of the closed form."""

    def below(x: float) -> float:
        terms = [(x / 2) ** i / math.factorial(i) for i in range(freedom // 2)]
        return 1 - math.exp(-x / 2) * sum(terms)

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def _projection(width: int) -> np.ndarray:
    return np.random.default_rng(_SEED).standard_normal((width, PROJECTIONS))


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, first scaled by their largest part so that nothing overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _leaf_order(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A kd-tree's leaves: row order and bounds, by halving along the widest direction."""
    parts, leaves = [np.arange(len(points))], []
    while parts:
        rows = parts.pop()
        if len(rows) <= ROWS_A_LEAF:
            leaves.append(rows)
            continue
        own = points[rows]
        axis = np.argmax(own.max(axis=0) - own.min(axis=0))
        order = rows[np.argsort(own[:, axis], kind="stable")]
        parts += [order[len(order) // 2 :], order[: len(order) // 2]]
    return np.concatenate(leaves), np.append(0, np.cumsum([len(leaf) for leaf in leaves]))


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector, width) of the rows whose vector takes part.

    Left out are null keys, and vectors that are null, empty, all zero or hold a
    null or a number that is not finite.
    """
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = table.select(F.col(f"`{key}`").cast("bigint").alias("key"), values.alias("vector"))
    rows = rows.filter("key is not null and vector is not null")
    rows = rows.filter(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    return rows.withColumn("width", F.size("vector"))


def build_index(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per tree, written to the shared folder; every usable row is in one tree."""
    rows = usable(table, key, vector)
    widths = rows.groupBy("width").count()
    trees = F.ceil(F.col("count") * F.col("width") / TREE_VALUES).cast("int").alias("trees")
    rows = rows.join(F.broadcast(widths.select("width", trees)), "width")  # one row per width
    rows = rows.withColumn("tree", F.pmod(F.xxhash64("key"), F.col("trees")))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", ignore_index=True)
        vectors = np.array(part["vector"].to_list())
        points = _units(vectors) @ _projection(vectors.shape[1])
        order, bounds = _leaf_order(points)
        points = points[order]
        low = np.minimum.reduceat(points, bounds[:-1])
        high = np.maximum.reduceat(points, bounds[:-1])
        packed = [a.astype("<f8").tobytes() for a in (vectors[order], points, low, high)]
        keys = part["key"].to_numpy(np.int64)[order]
        return pd.DataFrame(
            [[part["width"][0], *packed, keys.astype("<i8").tobytes(), bounds.astype("<i8").tobytes()]],
            columns=["width", "vectors", "points", "low", "high", "keys", "bounds"],
        )

    kinds = "width int, vectors binary, points binary, low binary, high binary, keys binary, bounds binary"
    return materialize(rows.groupBy("width", "tree").applyInPandas(build, kinds), "trees")


class _Tree:
    def __init__(self, row) -> None:
        numbers = lambda name, kind="<f8": np.frombuffer(bytes(row[name]), kind)
        self.vectors = numbers("vectors").reshape(-1, row["width"])
        self.units = _units(self.vectors)
        self.points, self.low, self.high = (
            numbers(name).reshape(-1, PROJECTIONS) for name in ("points", "low", "high")
        )
        self.keys, self.bounds = numbers("keys", "<i8"), numbers("bounds", "<i8")

    def search(self, key: int, unit: np.ndarray, point: np.ndarray, k: int, limit: float) -> np.ndarray:
        """Rows of the `k` nearest found, ties to the smaller key."""
        outside = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        reach = (outside * outside).sum(axis=1)
        best, away, far = np.zeros(0, np.int64), np.zeros(0), np.inf
        leaves, at, step = np.argsort(reach, kind="stable"), 0, 1
        # The stopping test is made after 1, 2, 4, ... leaves; in between, rows are
        # dropped by the same limit.
        while at < len(leaves) and reach[leaves[at]] <= limit * far + _SLACK:
            own = leaves[at : at + step]
            rows = np.concatenate([np.arange(self.bounds[i], self.bounds[i + 1]) for i in own])
            shift = self.points[rows] - point
            near = (shift * shift).sum(axis=1) <= limit * far + _SLACK
            rows = rows[near & (self.keys[rows] != key)]
            # Rounded, as equal vectors must tie.
            gap = np.round(2 - 2 * (self.units[rows] @ unit), 12)
            rows, gap = np.append(best, rows), np.append(away, gap)
            order = np.lexsort((self.keys[rows], gap))[:k]
            best, away = rows[order], gap[order]
            if len(best) == k:
                far = max(0.0, away[-1])
            at, step = at + step, 2 * step
        return best


def nearest(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest rows found of each query but itself.

    `score` is the cosine of the original vectors in double precision; ties go to
    the smaller id. A query meets rows of its own width only. With fewer than `k`
    candidates all are returned. Rows that repeat a key count as candidates of
    their own, except for a query of that key; a key that is queried twice gives
    its answer once. Unusable vectors take no part; an empty index or no query
    gives an empty result.
    """
    asked = usable(queries, key, vector).dropDuplicates(["key"])
    schema = "query_id bigint, vec_id bigint, score double"
    limit = chi_square_quantile(confidence, PROJECTIONS)
    widest = asked.agg(F.max("width"), F.count("*")).first()
    blocks = max(1, math.ceil((widest[0] or 0) * widest[1] / BLOCK_VALUES))
    found = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)) == block)
        rows = own.toPandas()  # BLOCK_VALUES numbers on average
        shared = index.sparkSession.sparkContext.broadcast(
            {
                int(width): (part["key"].to_numpy(np.int64), np.array(part["vector"].to_list()))
                for width, part in rows.groupby("width")
            }
        )

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for _, row in batch.iterrows():
                    if row["width"] not in shared.value:
                        continue
                    tree, (keys, vectors) = _Tree(row), shared.value[row["width"]]
                    units = _units(vectors)
                    points = units @ _projection(vectors.shape[1])
                    for i, one in enumerate(keys):
                        at = tree.search(one, units[i], points[i], k, limit)
                        yield pd.DataFrame(
                            {"query_id": one, "vec_id": tree.keys[at], "score": cosine(tree.vectors[at], vectors[i])}
                        )

        part = index.repartition(max(1, index.count()), "vectors").mapInPandas(search, schema)
        part = _best(part, k)
        if blocks > 1:
            part = materialize(part, "neighbours")
        found = part if found is None else found.unionByName(part)
    return found


def _power(x: np.ndarray) -> np.ndarray:
    """A power of two of about the size of `x`: dividing by it loses nothing."""
    return 2.0 ** np.floor(np.log2(np.maximum(x, 1e-300)))


def cosine(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Cosines of each row with one vector, each summed on its own so that equal rows score equally."""
    rows = rows / _power(np.abs(rows).max(axis=1, keepdims=True, initial=0))
    one = one / _power(np.abs(one).max())
    lengths = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((one * one).sum())
    return (rows * one).sum(axis=1) / lengths


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
