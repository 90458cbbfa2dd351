"""Whitening against numpy's eigensolver and plain whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"


def expected(rows, components=4):
    """key, component -> (n, deviation, |whitened|, explained), by plain means."""
    sound = [
        (k, [math.floor(256 * c) for c in v]) for k, v in rows
        if v and all(c is not None and math.isfinite(c) and abs(256 * c) < 2**63 for c in v)
    ]
    fit = sorted({tuple(x) for _, x in sound})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = []
    for k, x in sound:
        off = [n * a - s for a, s in zip(x, sums)]
        for i in range(components):
            e, v = values[-1 - i], vectors[:, -1 - i]
            out.append((k, i + 1, n, sum(o * o for o in off), float(np.dot(np.array(off) / n, v) / e**0.5), e / values.sum()))
    return out


def check(got, want):
    got, want = (sorted(rows, key=lambda r: (str(r[0]), r[1], r[3], abs(r[4]))) for rows in (got, want))
    assert [tuple(r[:4]) for r in got] == [tuple(r[:4]) for r in want]
    for component in range(1, 5):
        a = np.array([r[4] for r in got if r[1] == component])
        b = np.array([r[4] for r in want if r[1] == component])
        assert np.allclose(np.abs(a), np.abs(b), rtol=1e-8, atol=1e-8)
        assert abs(abs(np.dot(a, b)) - np.dot(b, b)) <= 1e-6 * max(1, np.dot(b, b))
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(r[6] <= 1e-9 for r in got)


def test_given_vectors(spark):
    got = queries.queries()["op13_whitening"](spark, FOLDER).collect()
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    check([tuple(r) for r in got], expected([(r[0], r[1]) for r in rows]))


def test_odd_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in draw.normal(size=5) * [9, 5, 3, 2, 1] + 1e6]) for i in range(200)]
    rows += [rows[7]] * 150 + [(None, rows[8][1]), (7, rows[9][1])]
    junk = [(1, None), (2, []), (3, [None] * 5), (4, [math.nan] * 5), (5, [1.0, 2.0, math.inf, 0.0, 0.0]), (6, [1e30] * 5)]
    short = [(900 + i, [1.0, 2.0]) for i in range(20)]
    table = spark.createDataFrame(
        [(*r, 1, 2.0) for r in rows + junk + short], "vec_id bigint, embedding array<double>, n int, WHITENED double"
    )
    want = expected(rows)
    got = whitening.whiten(table)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check([tuple(r) for r in got.collect()], want)
    again = whitening.whiten(table.repartition(7)).collect()
    check([tuple(r) for r in again], want)
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.filter("vec_id between 1 and 6 and size(embedding) = 2")).collect() == []
    same = table.filter(F.col("vec_id") == 20)
    assert whitening.whiten(same.union(same)).collect() == []


def test_rank(spark):
    rows = [(i, [float(i), 2.0 * i, 0.5]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert [r.component for r in got] == [1] * 20 and abs(got[0].explained - 1) < 1e-12


def test_deviation_beyond_a_long():
    model = whitening.Model(3, [3 * 2**61 + 1, 5], [], np.zeros((0, 2)), 0.0)
    x = np.array([[2**61, 1], [0, 0], [2**61 + 5, 40_000]])
    assert whitening._deviations(x, model) == [1 + 4, None, (15 - 1) ** 2 + (120_000 - 5) ** 2]


@pytest.mark.parametrize("seed", range(40))
def test_pairs(seed):
    draw = np.random.default_rng(seed)
    d = int(draw.integers(1, 14))
    base = np.linalg.qr(draw.normal(size=(d, d)))[0]
    values = np.sort(draw.choice([0.0, 1e-9, 1.0, 1.0 + 1e-9, 2.0, 5.0, 7e3], size=d) if seed % 2 else draw.random(d))[::-1]
    matrix = (base * values) @ base.T
    matrix = (matrix + matrix.T) / 2
    for shift in (0.5, -1.0, 1.5, 6.0):
        assert whitening.inertia(matrix - shift * np.eye(d)) == (int((values > shift).sum()), int((values < shift).sum()))
    pairs = whitening.leading_pairs(matrix, 4)
    top, tiny = values[0], 8 * d * 2.3e-16 * np.abs(matrix).sum(axis=1).max() if d else 0
    assert len(pairs) >= min(4, int((values > 4 * tiny).sum()))
    vectors = np.array([v for _, v in pairs]).reshape(-1, d)
    assert np.abs(vectors @ vectors.T - np.eye(len(pairs))).max(initial=0) < 1e-10
    for (value, vector), want in zip(pairs, values):
        assert abs(value - want) <= 4 * tiny + 1e-13 * top
        assert np.linalg.norm(matrix @ vector - value * vector) <= 1e-11 * max(top, 1e-300)
    assert [e for e, _ in pairs] == sorted((e for e, _ in pairs), reverse=True)
