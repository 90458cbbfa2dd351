"""Splits that keep near-copies together, against plain connected components."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import split
from tests.test_dedupe import chains, keys


def expected(rows):
    """split_key -> (group, split)."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for key, text in rows:
        mine = root(("key", key))
        for bucket in keys(text) if len(text) >= 50 else ():
            parent[root(("bucket", bucket))] = mine
    names = {}
    for key, _ in rows:
        r = root(("key", key))
        names[r] = min(names.get(r, key), key)
    groups = sorted(set(names.values()), key=lambda g: (hashlib.md5(f"42|{g}".encode()).hexdigest(), g))
    n = len(groups)
    train, val = max(1, math.floor(0.8 * n)), max(1, math.floor(0.1 * n)) if n > 2 else 0
    cut = {g: "train" if i < train else "val" if i < train + val else "test" for i, g in enumerate(groups)}
    return {key: (names[root(("key", key))], cut[names[root(("key", key))]]) for key, _ in rows}


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(f"repo/f{i // 3 if i % 4 else i % 40}.sv", text) for i, text in chains(21, 360)]
    return rows, spark.createDataFrame(
        [("t", "i", text, "", path) for path, text in rows],
        "task_type string, instruction string, input string, output string, source_path string",
    ).repartition(6)


def test_groups_and_cuts(pairs):
    rows, table = pairs
    # The text that is compared ends with a line feed and the empty output.
    want = expected([(path, text + "\n") for path, text in rows])
    for hot_rows in (10**6, 3):
        got = {r[0]: (r[1], r[2]) for r in split.near_split_assign(table, hot_rows=hot_rows).collect()}
        assert got == want
    assert len({g for g, _ in want.values()}) < len(want)


def test_no_near_pairs_are_parted(pairs):
    _, table = pairs
    rows = split.near_split_rows(table)
    assert rows.count() == table.count()
    assert split.near_leak_check(rows).first()["n_leaking"] == 0
    assert split.near_leak_check(split.split_rows(table)).first()["n_leaking"] > 0
    assert split.split_leak_check(rows).first()["n_leaking"] == 0


def test_pairs_signed_once_give_the_same(spark, pairs):
    _, table = pairs
    banded = split.with_bands(table)
    for rows in (split.near_split_rows(banded), split.split_rows(banded)):
        plain = rows.drop(split.BANDED)
        assert "ArrowEvalPython" not in split.near_leak_check(rows)._jdf.queryExecution().executedPlan().toString()
        assert split.near_leak_check(rows).first() == split.near_leak_check(plain).first()
    assert sorted(map(tuple, split.near_groups(banded).collect())) == sorted(map(tuple, split.near_groups(table).collect()))


def test_odd_pairs(spark):
    schema = "task_type string, instruction string, input string, output string, source_path string"
    none = spark.createDataFrame([], schema)
    assert split.near_split_rows(none).collect() == []
    assert tuple(split.near_leak_check(none.withColumn("split", F.lit("x"))).first()) == (0, 0)
    short = spark.createDataFrame([("t", "i", "x", None, None), ("t", "i", None, None, ""), ("t", "i", "x" * 80, "", "a")], schema)
    rows = split.near_split_rows(short).collect()
    assert len(rows) == 3 and all(r.split_key == r.split_group for r in rows)
