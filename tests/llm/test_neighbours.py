import math

import numpy as np
import pytest

from corpusmill.llm import neighbours, queries


def by_hand(rows, queries, k):
    found = {}
    good = {
        i: np.array(v, float) / np.abs(v).max()
        for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    }
    for q in queries:
        if q in good:
            a = good[q]
            near = [
                (-round(float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), 10), i)
                for i, b in good.items() if i != q and len(b) == len(a)
            ]
            found[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return found


def test_odd_vectors_and_ties(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0]), (11, [-1.0, 0.0]),
        (50, [1.0, 0.0, 0.0]), (100, [1e300, 1e300]), (101, [1e-300, 1e-300]), (None, [1.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, key string")
    asked = table.filter("vec_id in (0, 3, 4, 6, 50, 100)")
    found = neighbours.nearest(neighbours.build_index(table), asked, k=5)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 10)))
    want = by_hand(rows, [0, 3, 100], 5)
    want = {q: [(i, round(s, 10)) for i, s in near] for q, near in want.items()}
    assert set(got) == {0, 3, 100}
    assert got[0][:2] == [(1, 1.0), (10, 1.0)]
    for q in got:
        assert [round(s, 6) for _, s in got[q]] == [round(s, 6) for _, s in want[q]][: len(got[q])]
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)


@pytest.mark.parametrize("values", [1 << 19, 1 << 11])
def test_recall(spark, monkeypatch, values):
    monkeypatch.setattr(neighbours, "TREE_VALUES", values)
    monkeypatch.setattr(neighbours, "BLOCK_VALUES", 256)
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((600, 32))
    vectors[100:160] = vectors[0]  # a group of copies
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    asked = table.filter("vec_id % 50 = 0")
    found = neighbours.nearest(neighbours.build_index(table), asked, k=5).collect()
    want = by_hand([(i, v.tolist()) for i, v in enumerate(vectors)], range(0, 600, 50), 5)
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
        a, b = vectors[r.query_id], vectors[r.vec_id]
        assert abs(r.score - a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)) < 1e-12
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0] == [100, 101, 102, 103, 104]
    hits = sum(len(got[q] & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_empty(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert neighbours.nearest(neighbours.build_index(table), table).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id bigint, embedding array<float>")
    assert neighbours.nearest(neighbours.build_index(one), one).collect() == []


def test_chi_square_law():
    drawn = np.random.default_rng(1).chisquare(8, 200_000)
    assert abs((drawn <= neighbours.chi_square_quantile(0.97, 8)).mean() - 0.97) < 0.002


def test_query(spark):
    found = queries.queries()["op3_neighbours"](spark, "/root/testdata/sf0.001")
    assert found.count() == 10 * 5
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
