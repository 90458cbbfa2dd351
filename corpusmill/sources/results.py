"""Scored predictions, one folder per run tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.schemas import RESULTS
from corpusmill.sources.jsonl import read_records, write_records


def write_results(results: DataFrame, path: str) -> None:
    """Write the tags that `results` holds; a repeated tag is replaced, others stay."""
    write_records(results.select(RESULTS.fieldNames()), path, "tag", keep_others=True)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All tags that were written; a tag never run is simply absent."""
    return read_records(spark, path, RESULTS)
