"""Summaries counted while a table is written, against those computed from it."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedupe, label, lint, split
from corpusmill.plans import observed
from corpusmill.sources import corpus_text, jsonl, ordered_corpus
from corpusmill.workload import derived, registry
from tests.test_plans import plan

FOLDER = "/root/testdata/sf0.001"


class Sink:
    """Writes a table and reads it again."""

    def __init__(self, spark, path):
        self.spark, self.path, self.schema, self.writes = spark, str(path), None, 0

    def __call__(self, rows):
        self.schema, self.writes = rows.schema, self.writes + 1
        jsonl.write_records(rows, self.path)

    def table(self):
        return jsonl.read_records(self.spark, self.path, self.schema)


@pytest.fixture
def sink(spark, tmp_path):
    return Sink(spark, tmp_path / "out")


def same(summary, want):
    """Equal rows, and nothing but known numbers in the summary's plan."""
    columns = want.columns
    assert sorted(map(tuple, summary.select(*columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "Scan ExistingRDD" in plan(summary) and "FileScan" not in plan(summary) and "Exchange" not in plan(summary)


@pytest.fixture(scope="module")
def records(spark):
    return registry._records(spark, FOLDER)


def test_parse(records, sink):
    same(observed.parse_counts(records, sink), sink.table().groupBy("type").agg(F.count("*").alias("n_records")))


def test_dedupe(records, sink):
    order = ["ext_rank", "source_path", "pos"]
    summary = observed.dedupe_counts(records, order, sink)
    same(summary, dedupe.dedupe_stats(records, sink.table()))
    assert sink.writes == 1 and sink.table().count() == dedupe.dedupe(records, order).count()


def test_when_nothing_is_kept(spark, records, sink):
    """Adaptive execution drops the whole scan then, and its counts with it."""
    none = spark.createDataFrame([], "source_path string")
    summary = observed.kept_counts(records, lambda rows: rows.join(none, "source_path", "left_semi"), sink)
    same(summary, dedupe.dedupe_stats(records, sink.table()))


def test_label(records, sink):
    same(observed.label_counts(records, sink), label.label_stats(sink.table()))


def test_corpus(spark, records, tmp_path):
    path = str(tmp_path / "corpus")
    short = records.limit(5).withColumn("content", F.lit("  short "))
    chunks = records.union(short)
    same(observed.corpus_counts(chunks, path, ["source_path", "pos"]), corpus_text.cpt_stats(chunks))
    assert ordered_corpus.read_ordered(spark, path).count() == corpus_text.cpt_docs(chunks).count()


def test_lint_and_split(spark, sink):
    linted = registry._linted(spark, FOLDER)
    same(observed.lint_counts(linted, sink), lint.lint_stats(linted))
    assert sink.table().count() == lint.lint_filter(linted).count()
    rows = split.split_rows(derived.pairs(spark, FOLDER))
    same(observed.split_counts(rows, sink), split.split_stats(sink.table()))


def test_unknown_values_and_empty_tables(spark, sink, records):
    rows = spark.createDataFrame([("poem",), (None,), ("sv_file",)], "type string")
    assert sorted(map(tuple, observed.parse_counts(rows, sink).collect())) == [("other", 2), ("sv_file", 1)]
    none = records.limit(0)
    assert observed.parse_counts(none, sink).collect() == []
    assert [tuple(r) for r in observed.dedupe_counts(none, ["pos"], sink).collect()] == [("all", 0, 0, 0.0)]
    assert observed.label_counts(none, sink).collect() == []
    assert [r["n_rows"] for r in observed.split_counts(none.withColumn("split", F.lit("x")), sink).collect()] == [0, 0, 0]
