"""Whitening of embeddings by spectrum slicing.

The distinct vectors, in fixed-point whole numbers, are the fit list. Tasks sum
it, and then its centred products, a matrix for each task that Spark adds up by
rows; the driver gets one covariance matrix, whose size is set by the number of
dimensions. There the leading eigenvalues are found one by one: the inertia of
V - sI, read off its LDL^T factors, counts the eigenvalues above s, and
bisection by these counts isolates each; Rayleigh quotient iteration inside the
isolating interval converges cubically; two more counts, just below and just
above, certify the eigenvalue's number. Rows are then projected where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import discard, materialize

COMPONENTS = 4
SCALE = 256
#: Values up to this size are multiplied in 64-bit whole numbers.
_LIMIT = 2.0**63
_ALPHA = (1 + 17**0.5) / 8


# ---- one symmetric matrix ----------------------------------------------------
def inertia(matrix: np.ndarray) -> tuple[int, int]:
    """(positive, negative) eigenvalues, from LDL^T with complete (Bunch-Parlett) pivoting."""
    a = np.array(matrix, dtype=np.float64)
    positive = negative = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        p = int(diagonal.argmax())
        r, c = divmod(int(size.argmax()), len(a))
        if not size[r, c]:
            break
        pivot = [p] if diagonal[p] >= _ALPHA * size[r, c] else [r, c]
        if len(pivot) == 1:
            positive, negative = positive + int(a[p, p] > 0), negative + int(a[p, p] < 0)
        else:  # its off-diagonal entry outweighs the diagonal, so its determinant is negative
            positive, negative = positive + 1, negative + 1
        rest = np.delete(np.arange(len(a)), pivot)
        column = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - column @ np.linalg.solve(a[np.ix_(pivot, pivot)], column.T)
        a = (a + a.T) / 2
    return positive, negative


def count_above(matrix: np.ndarray, shift: float) -> int:
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def _isolate(matrix: np.ndarray, number: int, low: float, high: float, tiny: float) -> tuple[float, float]:
    """An interval around the `number`-th eigenvalue, others at least its width away, or no wider than `tiny`."""
    while high - low > tiny:
        width = high - low
        if count_above(matrix, high + width) == number - 1 and count_above(matrix, low - width) == number:
            break
        low, high = _halve(matrix, number, low, high)
    return low, high


def _halve(matrix: np.ndarray, number: int, low: float, high: float) -> tuple[float, float]:
    middle = (low + high) / 2
    return (middle, high) if count_above(matrix, middle) >= number else (low, middle)


def leading_pairs(matrix: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The `k` largest eigenvalues with unit eigenvectors, falling; those that are zero are left out.

    The largest entry of each vector is positive. Eigenvalues that agree to the
    last few digits cannot be told apart: their vectors are then an orthonormal
    base of the space they share.
    """
    d = len(matrix)
    if not d or not matrix.any():
        return []
    reach = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
    tiny = 8 * d * np.finfo(float).eps * reach
    found: list[tuple[float, np.ndarray]] = []
    high = reach + tiny
    for number in range(1, min(k, d) + 1):
        if count_above(matrix, tiny) < number:
            break
        low, high = _isolate(matrix, number, 0.0, high, tiny)
        value, vector = _refine(matrix, low, high, [v for _, v in found], tiny)
        certified = count_above(matrix, value + tiny) < number <= count_above(matrix, value - tiny)
        if not certified:
            raise ArithmeticError(f"eigenvalue {number} is not certified by the inertia counts")
        vector = vector * np.sign(vector[np.abs(vector).argmax()])
        found.append((value, vector))
        high = max(high, value + tiny)
        if found[:-1] and found[-2][0] < value:  # equal to the last digits
            found[-1] = (found[-2][0], vector)
    return found


def _refine(
    matrix: np.ndarray, low: float, high: float, known: list[np.ndarray], tiny: float
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration that stays in the interval; the interval shrinks when it leaves."""
    d, base = len(matrix), np.array(known).reshape(len(known), len(matrix))
    vector = np.random.default_rng(1 + len(known)).standard_normal(d)

    def clean(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - base.T @ (base @ v)
        return v / np.linalg.norm(v)

    def solve(shift: float, v: np.ndarray) -> np.ndarray:
        try:
            out = np.linalg.solve(matrix - shift * np.eye(d), v)
        except np.linalg.LinAlgError:
            out = np.linalg.solve(matrix - (shift + tiny / 4) * np.eye(d), v)
        return clean(out / np.abs(out).max())

    vector, wanted = clean(vector), 1 + len(known)
    while True:
        middle = (low + high) / 2
        for _ in range(6):  # towards the one eigenvalue in the interval
            vector = solve(middle, vector)
        value = float(vector @ matrix @ vector)
        for _ in range(12):
            if not low - tiny <= value <= high + tiny:
                break
            if np.linalg.norm(matrix @ vector - value * vector) <= tiny:
                return value, vector
            vector = solve(value, vector)
            value = float(vector @ matrix @ vector)
        if high - low <= tiny:
            return value, vector
        low, high = _halve(matrix, wanted, low, high)


# ---- tables -------------------------------------------------------------------
def fixed_point(vector: Column) -> Column:
    """Entries as floor(256 c); null where the vector or an entry is null, not finite or beyond a long."""
    entry = lambda c: c.cast("double") * SCALE
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(entry(c)) < F.lit(_LIMIT), F.lit(False)))
    return F.when(fits & (F.size(vector) > 0), F.transform(vector, lambda c: F.floor(entry(c)).cast("bigint")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.values[column.offsets[0].as_py() :].to_numpy()[: len(column) * d].reshape(-1, d)


@dataclass
class Model:
    """The fit list's size and sums (exact), and its leading components."""

    n: int
    sums: list[int]
    values: list[float]
    vectors: np.ndarray  # one row per component
    trace: float

    def whole(self) -> np.ndarray:
        """Whole means, rounded down."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    def part(self) -> np.ndarray:
        """What the exact means have over the whole ones."""
        return np.array([s % self.n / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One column per component."""
        centred = _minus(x, self.whole()) - self.part()
        return centred @ self.vectors.T / np.sqrt(self.values)


def _minus(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x - y as doubles, exact whole numbers where a long holds them."""
    with np.errstate(over="ignore"):
        rough = x.astype(np.float64) - y
        return np.where(np.abs(rough) < _LIMIT / 2, (x - y).astype(np.float64), rough)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), d)
            high, low = x >> 32, x & 0xFFFFFFFF  # so that no sum of a batch runs over
            total = [(int(h) << 32) + int(w) for h, w in zip(high.sum(axis=0), low.sum(axis=0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([len(x)] * d, pa.int64()), pa.array(map(str, total), pa.string())],
                ["place", "n", "total"],
            )

    parts = fit.select("x").mapInArrow(run, "place int, n bigint, total string")
    parts = parts.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = sorted(parts.collect())
    return (rows[0]["n"] if rows else 0), [int(r["total"]) for r in rows]


def _products(fit: DataFrame, d: int, columns: int, centred) -> np.ndarray:
    """The sum of centred products over the fit list; `centred(x)` has `columns` columns."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((columns, columns))
        for batch in batches:
            z = centred(_matrix(batch.column(0), d))
            total += z.T @ z
        rows = pa.array([row.tobytes() for row in total], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(columns), pa.int32()), rows], ["place", "values"])

    def added(key: tuple[pa.Scalar, ...], group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(columns)
        for batch in group:
            for row in batch["values"]:
                total += np.frombuffer(row.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["place", "values"])

    parts = fit.select("x").mapInArrow(partial, "place int, values binary")
    rows = parts.groupBy("place").applyInArrow(added, "place int, values binary").collect()
    out = np.zeros((columns, columns))
    for row in rows:
        out[row["place"]] = np.frombuffer(bytes(row["values"]))
    return (out + out.T) / 2


def fit(fit_list: DataFrame, d: int, components: int = COMPONENTS) -> tuple[Model, float]:
    """The model of `x`, distinct whole vectors of `d` entries, and its identity error.

    The error is the largest absolute entry of the covariance of the whitened fit
    list, less the identity; 0 where there is no component.
    """
    n, sums = _sums(fit_list, d)
    model = Model(n, sums, [], np.zeros((0, d)), 0.0)
    if not n:
        return model, 0.0
    whole, part = model.whole(), model.part()
    covariance = _products(fit_list, d, d, lambda x: _minus(x, whole) - part) / n
    pairs = leading_pairs(covariance, components)
    model.values, model.trace = [e for e, _ in pairs], float(np.trace(covariance))
    if not pairs:
        return model, 0.0
    model.vectors = np.array([v for _, v in pairs])
    # The whitened fit list is centred as it stands.
    whitened = _products(fit_list, d, len(pairs), model.whitened) / n
    return model, float(np.abs(whitened - np.eye(len(pairs))).max())


def _deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """The sum of (n x - S)^2, exact; null beyond a long."""
    whole, rest = model.whole(), np.array([s % model.n for s in model.sums], dtype=np.int64)
    far = np.abs(_minus(x, whole)).max(axis=1, initial=0) + 1
    out: list[int | None] = []
    plain = far * float(model.n) * x.shape[1] ** 0.5 < 2.0**31
    safe = np.where(plain[:, None], x, whole)
    y = model.n * (safe - whole) - rest
    for own, easy, total in zip(x, plain, (y * y).sum(axis=1)):
        if not easy:
            total = sum((model.n * int(v) - s) ** 2 for v, s in zip(own, model.sums))
        out.append(int(total) if total < _LIMIT else None)
    return out


def whiten(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per row of `table` with a sound vector, and component from 1.

    Columns: the key, `component`, `n` (distinct vectors), `deviation`, `whitened`,
    `explained` (the component's share of the whole variance) and `identity_error`.

    Rows whose vector is null, empty, or holds null, non-finite or (times 256)
    more than a long can hold take no part. Where lengths differ, the commonest
    counts (the longer, if tied) and other rows take no part. Repeated rows and
    keys give rows each, but count once in the fit; null keys pass. Without any
    variance (an empty table, one distinct vector) there is no component and so no
    row; with less rank than `components` there are as many as the rank. A
    deviation beyond a long is null. Equal eigenvalues share an arbitrary base.
    Other columns are left out, so none can clash.
    """
    rows = table.select(F.col(f"`{key}`").alias("key"), fixed_point(F.col(f"`{vector}`")).alias("x")).filter("x is not null")
    sizes = rows.groupBy(F.size("x").alias("d")).count()
    commonest = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    d = commonest["d"] if commonest else 0
    rows = rows.filter(F.size("x") == d)
    fit_list = materialize(rows.select("x").distinct(), "fit-list")
    model, error = fit(fit_list, d, components)
    discard(fit_list)
    shares = [e / model.trace for e in model.values]
    kind = rows.schema["key"].dataType
    count = len(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch) or not count:
                continue
            x = _matrix(batch.column(1), d)
            made = np.repeat(np.arange(len(x)), count)
            deviations = pa.array(_deviations(x, model), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(made)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(made), model.n, dtype=np.int64)),
                    deviations.take(pa.array(made)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(made), error)),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = (
        f"key {kind.simpleString()}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
