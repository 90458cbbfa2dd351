"""Chunks to split instruction pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from corpusmill import fixed_values as fv
from corpusmill.operators.lint import lint_filter, lint_status
from corpusmill.operators.pairs import bug_pairs, pair_key, pairs_union
from corpusmill.operators.split import split_rows
from corpusmill.runtime import materialize
from corpusmill.schemas import LINT_RESULTS, PAIRS


def build_pairs(
    chunks: DataFrame,
    key: Column,
    seeds: DataFrame,
    generated: DataFrame | None = None,
    lint_results: DataFrame | None = None,
    verify_tasks: Sequence[str] = fv.VERIFY_TASKS,
) -> DataFrame:
    """Pairs from all sources, linted, filtered and split.

    `key` names a chunk; pairs are told apart by the hash of their content, so
    equal pairs get equal verdicts.
    """
    parts = [bug_pairs(chunks, key), seeds] + ([generated] if generated is not None else [])
    pairs = pairs_union(*parts).withColumn("pair_id", pair_key())
    if lint_results is None:
        lint_results = chunks.sparkSession.createDataFrame([], LINT_RESULTS)
    kept = lint_filter(lint_status(pairs, lint_results, "pair_id", verify_tasks))
    # The split reads the pairs twice, for the cut points and for the rows.
    kept = materialize(kept, "pairs")
    return split_rows(kept).select(*PAIRS.fieldNames(), "split_key", "split")
