"""Overwrites that break off, and those that go through."""

import os

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import corpus_text, jsonl, publish, results
from corpusmill import schemas


def table(spark, *values):
    return spark.createDataFrame([(v, v % 2) for v in values], "n int, tag int")


def read(spark, path):
    return sorted(r["n"] for r in jsonl.read_records(spark, path, schema(spark)).collect())


def schema(spark):
    return table(spark, 1).schema


def failing(spark):
    rows = table(spark, *range(100, 200)).repartition(4)
    return rows.withColumn("n", F.when(F.col("n") == 177, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))


def left_over(path):
    return [f for f in os.listdir(os.path.dirname(path)) if f.startswith("_")]


def test_a_broken_overwrite_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    jsonl.write_records(table(spark, 1, 2, 3), path)
    with pytest.raises(Exception, match="lost"):
        jsonl.write_records(failing(spark), path)
    assert read(spark, path) == [1, 2, 3] and left_over(path) == []
    jsonl.write_records(table(spark, 4), path)
    assert read(spark, path) == [4] and left_over(path) == []


def test_a_first_write_that_breaks_off_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "deep" / "t")
    with pytest.raises(Exception, match="lost"):
        jsonl.write_records(failing(spark), path)
    assert not publish.exists(spark, path)
    jsonl.write_records(table(spark, 4), path)
    assert read(spark, path) == [4]


def test_a_table_read_while_it_is_overwritten(spark, tmp_path):
    path = str(tmp_path / "t")
    jsonl.write_records(table(spark, 1, 2), path)
    jsonl.write_records(jsonl.read_records(spark, path, schema(spark)).withColumn("n", F.col("n") * 10), path)
    assert read(spark, path) == [10, 20]


def test_an_end_between_the_renames_is_mended(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    jsonl.write_records(table(spark, 1), path)
    os.rename(path, str(tmp_path / "_old-t-abc"))
    assert publish.exists(spark, path) and read(spark, path) == [1]
    os.rename(path, str(tmp_path / "_old-t-abc"))
    jsonl.write_records(table(spark, 2), path)
    assert read(spark, path) == [2]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    jsonl.write_records(table(spark, 1, 2, 3), path, "tag", keep_others=True)
    with pytest.raises(Exception, match="lost"):
        jsonl.write_records(failing(spark), path, "tag", keep_others=True)
    assert read(spark, path) == [1, 2, 3]
    jsonl.write_records(table(spark, 5), path, "tag", keep_others=True)
    assert read(spark, path) == [2, 5] and left_over(path) == []
    jsonl.write_records(table(spark, 8), path, "tag")
    assert read(spark, path) == [8]


def test_a_broken_run_leaves_the_results_of_its_tag(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([("t", "p", 1.0, None, None, "base")], schemas.RESULTS)
    results.write_results(rows, path)
    broken = rows.withColumn("prediction", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        results.write_results(broken, path)
    assert [r["prediction"] for r in results.read_results(spark, path).collect()] == ["p"]


def test_the_corpus_too(spark, tmp_path):
    path = str(tmp_path / "c")
    docs = spark.createDataFrame([("a" * 40,)], "content string")
    corpus_text.write_corpus(docs, path)
    with pytest.raises(Exception, match="lost"):
        corpus_text.write_corpus(docs.select(F.raise_error(F.lit("lost")).cast("string").alias("content")), path)
    assert corpus_text.read_corpus(spark, path).count() == 1
