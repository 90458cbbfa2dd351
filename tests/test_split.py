"""Exact leak-free split."""

import hashlib
from collections import Counter

import pytest

from corpusmill.operators import split

COLUMNS = "task_type string, instruction string, input string, output string, source_path string"


def rows_of(keys):
    return [("t", "i", str(n), "o", key) for n, key in enumerate(keys)]


def split_of(spark, keys):
    rows = spark.createDataFrame(rows_of(keys), COLUMNS)
    return split.split_rows(rows)


@pytest.mark.parametrize(
    "n, sizes",
    [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (2, 1, 0)), (10, (8, 1, 1)), (17, (13, 1, 3)), (1000, (800, 100, 100))],
)
def test_sizes(spark, n, sizes):
    got = Counter(r["split"] for r in split_of(spark, [f"f{i}" for i in range(n)]).collect())
    assert tuple(got[s] for s in ("train", "val", "test")) == sizes


def test_keys_follow_the_hash_order(spark):
    keys = [f"repo/{i}.sv" for i in range(700)]
    ranked = sorted(keys, key=lambda k: (hashlib.md5(f"42|{k}".encode()).hexdigest(), k))
    want = {k: "train" if i < 560 else "val" if i < 630 else "test" for i, k in enumerate(ranked)}
    assert {r["split_key"]: r["split"] for r in split_of(spark, keys).collect()} == want


def test_a_source_with_a_third_of_the_rows_stays_whole(spark):
    keys = ["hot.sv" if i % 3 == 0 else f"f{i % 50}" for i in range(3000)]
    rows = split_of(spark, keys)
    assert rows.filter("source_path = 'hot.sv'").select("split").distinct().count() == 1
    check = split.split_leak_check(rows).first()
    assert (check["n_keys"], check["n_leaking"]) == (51, 0)


def test_rows_without_a_source_are_their_own_groups(spark):
    rows = split_of(spark, [None, "", None, "a"])
    assert rows.select("split_key").distinct().count() == 4


def test_another_seed_gives_another_split(spark):
    rows = spark.createDataFrame(rows_of([f"f{i}" for i in range(200)]), COLUMNS)
    one, two = ({r["split_key"]: r["split"] for r in split.split_rows(rows, s).collect()} for s in (1, 2))
    assert one != two and Counter(one.values()) == Counter(two.values())


def test_stats_show_empty_splits(spark):
    got = {r["split"]: (r["n_rows"], r["warn_empty"]) for r in split.split_stats(split_of(spark, ["a"])).collect()}
    assert got == {"train": (1, False), "val": (0, True), "test": (0, True)}


def test_same_for_any_partitioning(spark):
    keys = [f"f{i % 97}" for i in range(500)]
    rows = spark.createDataFrame(rows_of(keys), COLUMNS)
    one = {r["split_key"]: r["split"] for r in split.split_rows(rows.repartition(1)).collect()}
    many = {r["split_key"]: r["split"] for r in split.split_rows(rows.repartition(37)).collect()}
    assert one == many


def test_no_join_or_shuffle_of_the_rows(spark):
    plan = split_of(spark, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
