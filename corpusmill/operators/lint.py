"""Lint routing: outcomes of an outside checker folded per pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv
from corpusmill.functions.text import code_blocks, first_code
from corpusmill.runtime import materialize


def code_sha(code: Column) -> Column:
    return F.sha2(code, 256)


def _checked(output: Column) -> Column:
    """The code of an answer: its blocks, or all of an assertion answer without any."""
    blocks = code_blocks(output)
    whole = (F.size(blocks) == 0) & (F.col("task_type") == fv.TASK_ASSERT)
    return F.when(whole, F.array(output)).otherwise(blocks)


def one_verdict(lint_results: DataFrame) -> DataFrame:
    """One row per hash: of several outcomes unknown wins, then failed.

    It is written, as Spark splits a hot hash only in a join of plain inputs.
    """
    outcomes = lint_results.groupBy("code_sha").agg(
        F.bool_or(F.col("ok").isNull()).alias("unknown"), F.bool_and("ok").alias("all_ok")
    )
    single = outcomes.select("code_sha", F.when(~F.col("unknown"), F.col("all_ok")).alias("ok"))
    return materialize(single, "verdicts")


def blocks_to_check(pairs: DataFrame, verify_tasks: Sequence[str] = fv.VERIFY_TASKS) -> DataFrame:
    """Each distinct code block once, for the checker to run on."""
    return (
        pairs.filter(F.col("task_type").isin(*verify_tasks))
        .select(F.explode(_checked(F.col("output"))).alias("code"))
        .select(code_sha(F.col("code")).alias("code_sha"), "code")
        .distinct()
    )


def lint_status(
    pairs: DataFrame,
    lint_results: DataFrame,
    key: str = "pair_id",
    verify_tasks: Sequence[str] = fv.VERIFY_TASKS,
) -> DataFrame:
    """Add `lint_status`.

    A block without a result counts as unknown. One unknown block makes the pair
    unavailable, else one failing block makes it fail, else it passes. Only
    (key, hash) rows meet the results, which have one row per hash, so a hash
    that many pairs share is one that adaptive execution can split.
    """
    blocks = pairs.filter(F.col("task_type").isin(*verify_tasks)).select(
        key, F.explode(_checked(F.col("output"))).alias("code")
    )
    verdicts = (
        blocks.select(key, code_sha(F.col("code")).alias("code_sha"))
        .join(one_verdict(lint_results), "code_sha", "left")
        .groupBy(key)
        .agg(F.bool_or(F.col("ok").isNull()).alias("unknown"), F.bool_and("ok").alias("all_ok"))
        .select(
            key,
            F.when(F.col("unknown"), fv.LINT_UNAVAILABLE)
            .when(F.col("all_ok"), fv.LINT_PASS)
            .otherwise(fv.LINT_FAIL)
            .alias("lint_status"),
        )
    )
    return pairs.join(verdicts, key, "left").fillna(fv.LINT_NA, ["lint_status"])


def lint_filter(pairs: DataFrame) -> DataFrame:
    return pairs.filter(~F.col("lint_status").eqNullSafe(fv.LINT_FAIL))


def lint_stats(pairs: DataFrame) -> DataFrame:
    """Counts before the filter; skipped includes pairs whose checker was missing."""
    status = F.col("lint_status")
    return pairs.agg(
        F.count("*").alias("n_pairs"),
        F.count_if(status == fv.LINT_PASS).alias("n_passed"),
        F.count_if(status == fv.LINT_FAIL).alias("n_failed"),
        F.count_if(status.isin(fv.LINT_NA, fv.LINT_UNAVAILABLE)).alias("n_skipped"),
        F.count_if(status.eqNullSafe(fv.LINT_FAIL)).alias("n_dropped"),
    )


def with_first_code_ok(rows: DataFrame, text: str, lint_results: DataFrame) -> DataFrame:
    """Add `code` (first block or whole text) and `ok`; an unknown outcome is false."""
    return (
        rows.withColumn("code", first_code(F.col(text)))
        .withColumn("code_sha", code_sha(F.col("code")))
        .join(one_verdict(lint_results), "code_sha", "left")
        .withColumn("ok", F.coalesce("ok", F.lit(False)))
        .drop("code_sha")
    )
