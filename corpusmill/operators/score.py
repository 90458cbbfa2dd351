"""Scoring of predictions, per run tag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv
from corpusmill.functions.rouge import rouge_l
from corpusmill.operators.lint import with_first_code_ok
from corpusmill.operators.prefs import sft_text


def eval_prompts(benchmark: DataFrame) -> DataFrame:
    """The instruction text with an empty response."""
    return sft_text(benchmark, F.lit("")).withColumnRenamed("text", "prompt")


def eval_join(benchmark: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each prediction with its benchmark item."""
    return predictions.join(benchmark, "item_id")


def eval_throughput(rows: DataFrame) -> DataFrame:
    """Add `tok_per_sec`, over all tokens of the sequence, prompt included."""
    rate = F.col("n_tokens_total") / F.greatest(F.col("elapsed_s"), F.lit(fv.MIN_ELAPSED_S))
    return rows.withColumn("tok_per_sec", rate)


def eval_rouge(rows: DataFrame) -> DataFrame:
    """Add `rouge_l`; null where the item has no reference."""
    return rows.withColumn("rouge_l", rouge_l(F.col("prediction"), F.col("reference")))


def eval_compiles(rows: DataFrame, lint_results: DataFrame) -> DataFrame:
    """Add `compiles` for the two task types that answer in code, else null."""
    in_scope = F.coalesce(F.col("task_type").isin(*fv.COMPILE_TASKS), F.lit(False))
    # Only rows in scope are hashed and joined.
    checked = with_first_code_ok(rows.filter(in_scope), "prediction", lint_results)
    others = rows.filter(~in_scope).withColumn("compiles", F.lit(None).cast("boolean"))
    return checked.withColumnRenamed("ok", "compiles").drop("code").unionByName(others)


def eval_summary(results: DataFrame) -> DataFrame:
    """Per tag: a missing score counts as 0, the compile rate is over rows with the flag."""
    return results.groupBy("tag").agg(
        F.count("*").alias("n_rows"),
        (F.sum(F.coalesce("rouge_l", F.lit(0.0))) / F.greatest(F.count("*"), F.lit(1))).alias(
            "avg_rouge_l"
        ),
        (
            F.count_if("compiles") / F.greatest(F.count("compiles"), F.lit(1))
        ).alias("compile_rate"),
    )


def reward(completions: DataFrame, lint_results: DataFrame, text: str = "completion") -> DataFrame:
    """Add `reward`: 1.0 compiles and asserts, 0.3 compiles only, else 0.0."""
    checked = with_first_code_ok(completions, text, lint_results)
    asserts = F.col("code").contains(fv.ASSERTION)
    value = (
        F.when(F.col("ok") & asserts, fv.REWARD_FULL)
        .when(F.col("ok"), fv.REWARD_COMPILES)
        .otherwise(0.0)
    )
    return checked.withColumn("reward", value).drop("code", "ok")
