"""Preference pairs and the text views that training reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv

_ASSERT_LINE = rf"(?md)^({fv.WS}*)({fv.ASSERTION}.*)$"


def make_rejected(text: Column) -> Column:
    """Comment out each line that starts with an assertion.

    Null when nothing changed, for instance because the assertion has a label.
    """
    disabled = F.regexp_replace(text, _ASSERT_LINE, f"$1// $2{fv.DISABLED_NOTE}")
    return F.when(text.contains(fv.ASSERTION) & (disabled != text), disabled)


def prompt() -> Column:
    return F.concat(F.col("instruction"), F.lit(fv.PROMPT_CODE), F.col("input"))


def dpo_pairs(train: DataFrame) -> DataFrame:
    """prompt, chosen, rejected for assertion tasks whose answer can be disabled."""
    return (
        train.filter(F.col("task_type") == fv.TASK_ASSERT)
        .select(
            prompt().alias("prompt"),
            F.col("output").alias("chosen"),
            make_rejected(F.col("output")).alias("rejected"),
        )
        .filter(F.col("rejected").isNotNull())
    )


def rl_prompts(train: DataFrame) -> DataFrame:
    """Assertion tasks with a `prompt` column added."""
    return train.filter(F.col("task_type") == fv.TASK_ASSERT).withColumn("prompt", prompt())


def require_prompts(prompts: DataFrame) -> DataFrame:
    """`prompts`, or an error where there is none: reward training cannot start on nothing."""
    if prompts.isEmpty():
        raise ValueError(f"no row of task {fv.TASK_ASSERT}: there is nothing to train on")
    return prompts


def sft_text(rows: DataFrame, response: Column | None = None) -> DataFrame:
    """Add `text`: instruction, input and response under their headings."""
    answer = F.col("output") if response is None else response
    text = F.concat(
        F.lit(fv.HEAD_INSTRUCTION),
        F.col("instruction"),
        F.lit(fv.HEAD_INPUT),
        F.col("input"),
        F.lit(fv.HEAD_RESPONSE),
        answer,
    )
    return rows.withColumn("text", text)


def size_guards(preferences: DataFrame, prompts: DataFrame) -> DataFrame:
    """Row counts of both tables and whether training may start on them."""
    n = F.col("n_rows")

    def guard(table: DataFrame, name: str, verdict: Column) -> DataFrame:
        return table.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", verdict.alias("verdict")
        )

    return guard(
        preferences,
        "preference_pairs",
        F.when(n == 0, "warn_empty").when(n < fv.MIN_PREFERENCE_PAIRS, "warn_few").otherwise("ok"),
    ).union(guard(prompts, "reward_prompts", F.when(n == 0, "stop_empty").otherwise("ok")))
