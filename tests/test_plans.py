"""Physical plans: pruning, push-down, skew handling, no all-pairs joins."""

import contextlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusmill.operators import dedupe, label, lint, pairs, score
from corpusmill.workload import derived

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_skew_limits(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


@pytest.mark.parametrize(
    "name", ["label_stats", "bug_pairs", "lint_status", "split_rows", "dpo_pairs", "reward", "eval_summary"]
)
def test_no_all_pairs_join(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_needed_columns_are_read(spark):
    docs = derived.document_records(spark, FOLDER)
    text = plan(label.label_stats(label.label_chunks(docs)))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "source" not in scan.split("Batched")[0] and "lang" not in scan.split("Batched")[0]


def test_filters_reach_the_scan(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = plan(dedupe.long_enough(docs, "text").filter(F.col("doc_id") > 5))
    assert "PushedFilters: [" in text and "GreaterThan(doc_id,5)" in text


def hot_rows(spark, n=9000):
    """A third of the rows hold the same code."""
    return spark.range(n).select(
        F.col("id").alias("pair_id"),
        F.lit("rtl_generation").alias("task_type"),
        F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(s))) for s in "abcd"]).alias("input"),
        F.concat(
            F.lit("```\n"),
            F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.md5(F.col("id").cast("string"))),
            F.lit("\n```"),
        ).alias("output"),
    ).repartition(8, "pair_id")


def outcomes(spark, rows):
    return lint.blocks_to_check(rows).select("code_sha", (F.length("code") == 4).alias("ok"))


def test_a_code_block_shared_by_a_third_of_the_pairs_is_split(spark):
    rows = hot_rows(spark)
    with small_skew_limits(spark):
        rewards = score.reward(rows, outcomes(spark, rows), "output")
        got = {r["reward"]: r["count"] for r in rewards.groupBy("reward").count().collect()}
        assert got == {0.3: 3000, 0.0: 6000}
        rewards.collect()
        assert "skew=true" in plan(rewards)
        status = lint.lint_status(rows, outcomes(spark, rows))
        got = {r["lint_status"]: r["count"] for r in status.groupBy("lint_status").count().collect()}
        assert got == {"verified_pass": 3000, "verified_fail": 6000}


def test_bucket_list_for_broadcast_is_bounded(spark):
    """The limit grows with the table, so the list of hot buckets cannot."""
    rows = [(i, bytes([b])) for i in range(400) for b in (i % 7, 100 + i % 11)]
    members = spark.createDataFrame(rows, "__ord bigint, bucket binary")
    old = dedupe.MAX_HOT_BUCKETS
    dedupe.MAX_HOT_BUCKETS = 4
    try:
        shared = dedupe._shared_buckets(members, hot_rows=1)
        # 800 member rows and at most 4 hot buckets: the limit is 200, above every bucket.
        assert shared.agg(F.max("salts")).first()[0] == 1 and shared.count() == 800
    finally:
        dedupe.MAX_HOT_BUCKETS = old
    salted = dedupe._shared_buckets(members, hot_rows=10)
    assert salted.agg(F.max("salts")).first()[0] == 6 and salted.count() == 800
    assert salted.select("bucket", "salt").distinct().count() > 18


def test_prompts_are_not_broadcast_however_small_their_source(spark):
    """Forty texts of a megabyte come from a column of numbers, which is all that Spark knows of their size."""
    ids = spark.range(40)
    prompts = ids.select(
        F.lit("a.sv").alias("source_path"), F.repeat(F.lit("x"), 1 << 20).alias("content"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("prompt_key"),
    )
    answers = prompts.filter(F.col("prompt_key") != "k7").select("prompt_key", F.lit("It is so.").alias("completion"))
    made = pairs.gen_ingest(prompts, answers.union(answers))
    assert made.filter(F.length("input") == 1 << 20).count() == 39
    assert "BroadcastHashJoin" not in plan(made) and "BroadcastExchange" not in plan(made)


def test_pairs_union_never_sends_its_texts_to_the_driver(spark, tmp_path):
    """Each of its parts is made, and no table of texts is broadcast, before or after the sizes are known."""
    part = [(i, f"almond {i}", "7", 3) for i in range(1, 60)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="1g",
        spark__sql__adaptive__autoBroadcastJoinThreshold="1g",
    ):
        made = entry.queries()["pairs_union"](spark, str(tmp_path))
        first = plan(made)
        assert {row.task_type for row in made.collect()} >= {"rtl_bug_finding", "rtl_explanation", "register_map_qa"}
        last = plan(made)
    assert "isFinalPlan=false" in first and "isFinalPlan=true" in last
    for text in (first, last):
        assert "SortMergeJoin" in text and "Broadcast" not in text
