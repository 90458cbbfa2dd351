"""Batches against an index give the records of one walk over all of them."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedupe
from corpusmill.operators.near_index import NearIndex
from tests.test_dedupe import chains, keys, kept_ids, walk
from tests.test_plans import plan, settings


@pytest.fixture(scope="module")
def rows():
    return chains(11, 300)


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, content string").repartition(4)


def test_batches_equal_one_run(spark, rows, table, tmp_path):
    index = NearIndex(spark, str(tmp_path / "index"), buckets=4)
    parts = [table.filter("id < 120"), table.filter("id between 120 and 121"), table.filter("id > 121")]
    kept = [i for k, part in enumerate(parts) for i in kept_ids(index.insert(part, ["id"], f"b{k}"))]
    assert sorted(kept) == walk(rows)
    assert index.rows().count() == index.rows().select("bucket").distinct().count() == 8 * len(kept)
    # Another session knows nothing but the path.
    index.close()
    again = NearIndex(spark, str(tmp_path / "index"))
    assert (again.batches, again.buckets) == (["b0", "b1", "b2"], 4)
    assert again.insert(table, ["id"], "b3").count() == 0
    assert kept_ids(again.insert(parts[0], ["id"], "b0")) == [i for i in kept if i < 120]


def test_order_of_batches_counts(spark, rows, table, tmp_path):
    index = NearIndex(spark, str(tmp_path / "index"), buckets=2)
    late = kept_ids(index.insert(table.filter("id >= 150"), ["id"], "late"))
    early = kept_ids(index.insert(table.filter("id < 150"), ["id"], "early"))
    turned = [((i < 150, i), text) for i, text in rows]
    assert sorted((i < 150, i) for i in late + early) == walk(turned)


def test_an_attempt_that_broke_off_is_not_seen(spark, rows, table, tmp_path, monkeypatch):
    index = NearIndex(spark, str(tmp_path / "index"), buckets=2)
    first = kept_ids(index.insert(table.filter("id < 100"), ["id"], "a"))
    counted = index.rows().count()

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(spark, "createDataFrame", broken)  # the commit
        with pytest.raises(OSError):
            index.insert(table.filter("id >= 100"), ["id"], "b")
    assert index.batches == ["a"] and index.rows().count() == counted
    assert spark.table(index.table).count() > counted
    second = kept_ids(NearIndex(spark, str(tmp_path / "index")).insert(table.filter("id >= 100"), ["id"], "b"))
    assert sorted(first + second) == walk(rows)


def test_lookup(spark, rows, table, tmp_path):
    index = NearIndex(spark, str(tmp_path / "index"), buckets=2)
    first = kept_ids(index.insert(table.filter("id < 150"), ["id"], "a"))
    texts = dict(rows)
    want = {}
    for i in range(150, 300):
        if len(texts[i]) >= 50:
            near = [k for k in first if keys(texts[k]) & keys(texts[i])]
            if near:
                want[i] = ("a", near[0])
    found = index.lookup(table.filter("id >= 150"), ["id"]).collect()
    assert {r["id"]: (r["batch"], r["key"]["id"]) for r in found} == want and len(found) == len(want) > 5


def test_the_index_is_not_shuffled_and_holds_no_text(spark, table, tmp_path):
    index = NearIndex(spark, str(tmp_path / "index"), buckets=4)
    index.insert(table.filter("id < 200"), ["id"], "a")
    assert index.rows().columns == ["bucket", "key", "place", "number", "batch"]
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        members = dedupe.band_members(dedupe.band_table(table.filter("id >= 200"), ["id"], "content"))
        text = plan(members.join(index.rows(), "bucket").select("__ord"))
    index_side = text[text.index("SortMergeJoin") :].split("BroadcastHashJoin")
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1 and len(index_side) == 2


def test_odd_batches(spark, table, tmp_path):
    with pytest.raises(ValueError):
        NearIndex(spark, str(tmp_path / "none")).rows()
    index = NearIndex(spark, str(tmp_path / "index"), buckets=2)
    assert index.insert(table.limit(0), ["id"], "empty").count() == 0
    assert index.lookup(table, ["id"]).count() == 0
    short = spark.createDataFrame([(1, "short"), (2, None)], "id bigint, content string")
    assert index.insert(short, ["id"], "short").count() == 0
    twice = table.filter("id < 30").withColumn("pos", F.lit(1)).withColumnRenamed("id", "path")
    order = ["path", "pos"]
    other = NearIndex(spark, str(tmp_path / "other"), buckets=2)
    kept = {r.path for r in other.insert(twice, order, "a").collect()}
    assert kept == {r.path for r in dedupe.dedupe(twice, order).collect()}
