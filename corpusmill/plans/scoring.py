"""Predictions to scored results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusmill.operators.score import eval_compiles, eval_join, eval_rouge, eval_throughput
from corpusmill.schemas import RESULTS


def score_predictions(
    benchmark: DataFrame, predictions: DataFrame, lint_results: DataFrame
) -> DataFrame:
    rows = eval_throughput(eval_rouge(eval_join(benchmark, predictions)))
    return eval_compiles(rows, lint_results).select(RESULTS.fieldNames())
