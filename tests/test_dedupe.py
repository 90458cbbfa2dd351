"""Near-duplicate removal against the sequential walk."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import sketch
from corpusmill.operators import dedupe


def keys(text: str) -> set:
    sig = sketch.minima(sketch.shingle_hashes(" ".join(text.lower().split())))
    return {(b, tuple(sig[b * 16 : b * 16 + 16])) for b in range(8)}


def walk(texts: list[tuple[int, str]]) -> list[int]:
    """In order: keep a record unless a kept earlier one shares a bucket."""
    owned, kept = set(), []
    for i, text in sorted(texts):
        if len(text) < 50:
            continue
        mine = keys(text)
        # A bucket is closed as soon as one kept record is in it.
        if not mine & owned:
            kept.append(i)
            owned |= mine
    return kept


def chains(seed: int, n: int = 400) -> list[tuple[int, str]]:
    """Texts that drift word by word, copies, short and blank ones, in mixed order."""
    rng, rows, text = random.Random(seed), [], None
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    for i in range(n):
        if text is None or rng.random() < 0.08:
            text = rng.choices(words, k=60)
        else:
            text = list(text)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append(" ".join(text) if rng.random() > 0.03 else rng.choice([" " * 60, "\n" * 70, "short"]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def table(spark):
    rows = chains(1)
    return spark.createDataFrame(rows, "id bigint, content string").repartition(5), walk(rows)


def kept_ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_equals_the_walk(table):
    records, want = table
    assert 20 < len(want) < 300
    assert kept_ids(dedupe.dedupe(records, ["id"])) == want


def test_hot_buckets_are_salted_without_change(spark, table):
    records, want = table
    assert kept_ids(dedupe.dedupe(records, ["id"], hot_rows=2)) == want


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_same_for_any_partitioning(spark, table, partitions):
    records, want = table
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert kept_ids(dedupe.dedupe(records.repartition(int(partitions)), ["id"])) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_order_by_several_columns(spark, table):
    records, want = table
    # Zero-padded names sort as the ids do.
    named = records.withColumn("path", F.lpad(F.col("id").cast("string"), 6, "0")).withColumn("pos", F.lit(0))
    assert kept_ids(dedupe.dedupe(named, ["path", "pos"])) == want


def test_the_order_column_may_have_any_name(table):
    records, want = table
    for name in ("ord", "bands", "bucket"):
        renamed = records.withColumnRenamed("id", name)
        assert sorted(r[name] for r in dedupe.dedupe(renamed, [name]).collect()) == want


def test_a_second_run_removes_nothing(table):
    records, want = table
    once = dedupe.dedupe(records, ["id"])
    assert kept_ids(dedupe.dedupe(once, ["id"])) == want


def test_more_seeds(spark):
    for seed in (2, 3):
        rows = chains(seed, 250)
        records = spark.createDataFrame(rows, "id bigint, content string")
        assert kept_ids(dedupe.dedupe(records, ["id"], hot_rows=3)) == walk(rows)


def test_removed_records_remove_nothing(spark):
    """A~B, B~C and not A~C keeps A and C; and random buckets follow the walk."""
    rng = random.Random(4)
    rows = [(0, [b"x", b"p"]), (1, [b"x", b"y"]), (2, [b"y", b"q"])]
    rows += [(i, [b"%d" % rng.randrange(900) for _ in range(3)]) for i in range(3, 1200)]
    members = spark.createDataFrame([(i, b) for i, own in rows for b in set(own)], "__ord bigint, bucket binary")
    closed, kept = set(), []
    for i, buckets in rows:
        if not closed & set(buckets):
            kept.append(i)
            closed |= set(buckets)
    removed = [
        r["__ord"]
        for part in dedupe._removed_in_rounds(dedupe._shared_buckets(members, 2))
        for r in part.collect()
    ]
    assert {0, 2} <= set(kept) and sorted(removed) == sorted(set(range(1200)) - set(kept))


def _kept_by_walk(rows):
    closed, kept = set(), set()
    for i, buckets in sorted(rows):
        if not closed & set(buckets):
            kept.add(i)
            closed |= set(buckets)
    return kept


def _decided(spark, monkeypatch, rows, walk_rows):
    """The kept records, and the number of written steps."""
    frame = pd.DataFrame([(i, b"%d" % b) for i, own in rows for b in set(own)], columns=["__ord", "bucket"])
    members = spark.createDataFrame(frame, "__ord bigint, bucket binary").repartition(8)
    shared, steps = dedupe._shared_buckets(members, 1000), []
    write = dedupe.materialize
    monkeypatch.setattr(dedupe, "materialize", lambda df, label: steps.append(label) or write(df, label))
    removed = dedupe._removed_in_rounds(shared, walk_rows)
    gone = [r[0] for part in removed for r in part.collect()]
    assert len(gone) == len(set(gone))
    return {i for i, _ in rows} - set(gone), steps


def test_a_chain_of_100_000_records_takes_few_steps(spark, monkeypatch):
    rows = [(i, [i, i + 1]) for i in range(100_000)]
    kept, steps = _decided(spark, monkeypatch, rows, dedupe.WALK_ROWS)
    assert kept == set(range(0, 100_000, 2)) and len(steps) <= 12


def test_components_are_walked_apart_and_large_ones_in_parts(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(-i, [i, i + 1]) for i in range(2000)]  # one long chain, against the order of its links
    rows += [(10_000 + 40 * c + i, [10**6 + 100 * c + i, 10**6 + 100 * c + i + 1]) for c in range(30) for i in range(25)]
    rows += [(20_000 + i, [2 * 10**6 + rng.randrange(500) for _ in range(4)]) for i in range(600)]
    kept, steps = _decided(spark, monkeypatch, rows, 1500)
    assert kept == _kept_by_walk(rows)
    assert steps.count("walked") >= 2 and "large-components" in steps


def test_length_limit_and_blank_records(spark):
    rows = [(1, "x" * 49), (2, "y" * 50), (3, " " * 60), (4, "\t" * 80)]
    records = spark.createDataFrame(rows, "id bigint, content string")
    assert kept_ids(dedupe.dedupe(records, ["id"])) == [2, 3]


def test_a_third_of_all_rows_in_one_group(spark):
    """Copies and near-copies of one text: 2000 of 6000 rows."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(500)]
    base = rng.choices(words, k=80)
    rows = []
    for i in range(6000):
        if i % 3:
            text = rng.choices(words, k=12)
        else:
            text = base[:79] + [rng.choice(words)] if i % 2 else base
        rows.append((i, " ".join(text)))
    records = spark.createDataFrame(rows, "id bigint, content string").repartition(8)
    assert kept_ids(dedupe.dedupe(records, ["id"], hot_rows=100)) == walk(rows)


def test_links_span_the_candidate_groups(table):
    records, _ = table
    by_bucket, rows = {}, {r["id"]: r["content"] for r in records.collect()}
    for i in sorted(rows):
        if len(rows[i]) >= 50:
            for key in keys(rows[i]):
                by_bucket.setdefault(key, []).append(i)
    want = {(ids[0], i) for ids in by_bucket.values() for i in ids[1:]}
    got = dedupe.bucket_links(records, "id", hot_rows=4).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want


def test_stats(spark):
    records = spark.createDataFrame([("a",), ("a",), ("b",)], "type string")
    kept = spark.createDataFrame([("a",)], "type string")
    got = {r["type"]: tuple(r)[1:] for r in dedupe.dedupe_stats(records, kept).collect()}
    assert got == {"a": (2, 1, 50.0), "b": (1, 0, 0.0), "all": (3, 1, pytest.approx(100 / 3))}
