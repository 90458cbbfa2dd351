"""The flows stage by stage: each reads JSON-Lines tables and writes one.

`report` tables are the small summaries a stage prints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.operators import lint, pairs, prefs, score, split
from corpusmill.operators.near_index import NearIndex
from corpusmill.operators.parse import raw_records
from corpusmill.plans import observed
from corpusmill.plans.corpus import RECORD_ORDER
from corpusmill.plans.scoring import score_predictions
from corpusmill.runtime import materialize
from corpusmill.sources import files, jsonl, results, seeds

SPLIT_PAIRS = schemas.StructType(schemas.PAIRS.fields).add("split_key", "string").add("split", "string")
REWARD_PROMPTS = schemas.StructType(SPLIT_PAIRS.fields).add("prompt", "string")
PROMPTS = schemas.StructType(schemas.CHUNKS_LABELED.fields).add("prompt", "string").add(
    "prompt_key", "string"
)


def _to(out: str) -> observed.Write:
    return lambda rows: jsonl.write_records(rows, out)


def record_key() -> Column:
    return F.concat_ws("#", "source_path", F.col("pos").cast("string"))


def _optional(spark: SparkSession, path: str | None, schema: schemas.StructType) -> DataFrame:
    table = jsonl.read_optional(spark, path, schema) if path else None
    return spark.createDataFrame([], schema) if table is None else table


def parse(spark: SparkSession, root: str, out: str, masked: bool = False) -> DataFrame:
    return observed.parse_counts(raw_records(files.scan_corpus(spark, root), masked), _to(out))


def remove_duplicates(
    spark: SparkSession, source: str, out: str, index: str | None = None, batch: str | None = None
) -> DataFrame:
    """With an index, also against the batches before; the batch is named by its source unless told."""
    records = jsonl.read_records(spark, source, schemas.RAW_RECORDS)
    if not index:
        return observed.dedupe_counts(records, RECORD_ORDER, _to(out))
    kept = NearIndex(spark, index).insert(records, RECORD_ORDER, batch or source)
    keys = materialize(kept.select(*RECORD_ORDER), "kept-keys")
    return observed.kept_counts(records, lambda rows: rows.join(keys, list(RECORD_ORDER), "left_semi"), _to(out))


def add_labels(spark: SparkSession, source: str, out: str) -> DataFrame:
    return observed.label_counts(jsonl.read_records(spark, source, schemas.RAW_RECORDS), _to(out))


def corpus(spark: SparkSession, source: str, out: str) -> DataFrame:
    chunks = jsonl.read_records(spark, source, schemas.CHUNKS_LABELED)
    return observed.corpus_counts(chunks, out, RECORD_ORDER)


def prompts(spark: SparkSession, source: str, out: str, n: int) -> DataFrame:
    """Prompts for an outside model; its answers come back as a completions table."""
    chunks = jsonl.read_records(spark, source, schemas.CHUNKS_LABELED)
    jsonl.write_records(pairs.gen_prompts(pairs.gen_candidates(chunks, record_key(), n), record_key()), out)
    return jsonl.read_records(spark, out, PROMPTS).agg(F.count("*").alias("n_prompts"))


def make_pairs(
    spark: SparkSession,
    source: str,
    out: str,
    prompt_table: str | None = None,
    completions: str | None = None,
    lint_results: str | None = None,
) -> DataFrame:
    chunks = jsonl.read_records(spark, source, schemas.CHUNKS_LABELED)
    generated = pairs.gen_ingest(
        _optional(spark, prompt_table, PROMPTS), _optional(spark, completions, schemas.COMPLETIONS)
    )
    made = pairs.pairs_union(
        pairs.bug_pairs(chunks, record_key()), seeds.seed_pairs(spark), generated
    ).withColumn("pair_id", pairs.pair_key())
    linted = lint.lint_status(made, _optional(spark, lint_results, schemas.LINT_RESULTS))
    return observed.lint_counts(linted, lambda kept: jsonl.write_records(kept.select(schemas.PAIRS.fieldNames()), out))


def blocks(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Distinct code blocks for an outside linter; its verdicts come back as lint results."""
    table = lint.blocks_to_check(jsonl.read_records(spark, source, schemas.PAIRS))
    jsonl.write_records(table, out)
    table = jsonl.read_records(spark, out, table.schema)
    return table.agg(F.count("*").alias("n_blocks"))


def split_pairs(spark: SparkSession, source: str, out: str, near: bool = False) -> DataFrame:
    """One folder per split, `split=train` and so on; with `near`, near-copies of other sources stay together."""
    made = jsonl.read_records(spark, source, schemas.PAIRS)
    rows = split.near_split_rows(made).drop("split_group") if near else split.split_rows(made)
    return observed.split_counts(rows, lambda made: jsonl.write_records(made, out, "split"))


def preferences(spark: SparkSession, source: str, out: str) -> DataFrame:
    """From the train split only, so that nothing of the others leaks in."""
    train = jsonl.read_records(spark, source, SPLIT_PAIRS).filter(F.col("split") == "train")
    jsonl.write_records(prefs.dpo_pairs(train), out)
    written = jsonl.read_records(spark, out, schemas.PREFERENCE_PAIRS)
    return prefs.size_guards(written, prefs.rl_prompts(train))


def reward_prompts(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Prompts for reward training, from the train split; without any the stage stops and writes nothing."""
    train = jsonl.read_records(spark, source, SPLIT_PAIRS).filter(F.col("split") == "train")
    jsonl.write_records(prefs.require_prompts(prefs.rl_prompts(train)), out)
    return jsonl.read_records(spark, out, REWARD_PROMPTS).agg(F.count("*").alias("n_prompts"))


def evaluate(
    spark: SparkSession, benchmark: str, predictions: str, lint_results: str | None, out: str
) -> DataFrame:
    scored = score_predictions(
        jsonl.read_records(spark, benchmark, schemas.BENCHMARK),
        jsonl.read_records(spark, predictions, schemas.PREDICTIONS),
        _optional(spark, lint_results, schemas.LINT_RESULTS),
    )
    results.write_results(scored, out)
    return score.eval_summary(results.read_results(spark, out))
